"""Where operators put intermediate tables, and how they find tables of a test folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OWN_DIR = "/tmp/boxwright-shared"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. A session on one machine may do without the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        java = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = java.get() if java.isDefined() else None
    if not found:
        if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = OWN_DIR  # one machine
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/boxwright/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    w = df.write.option("compression", "zstd")
    with shuffles_removed(spark):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._boxwright_path = path
    return out


def reread(df: DataFrame) -> DataFrame:
    """A table that cut() made as a table of its own, for joins with itself."""
    return df.sparkSession.read.schema(df.schema).parquet(df._boxwright_path)


def discard(df: DataFrame, part: str = "") -> None:
    """Delete a table that cut() made and nothing reads any more, or one partition of it."""
    path = getattr(df, "_boxwright_path", None)
    if path:
        remove(df.sparkSession, f"{path}/{part}" if part else path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """While a table is written, exchanges are for that table only: their files go as soon as it is whole."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table_bytes(df: DataFrame) -> int:
    """Size of the files behind a table that cut() made; the bound that a broadcast is checked against."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(df._boxwright_path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()
