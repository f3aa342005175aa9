"""The annotation loop as a stream: base rows arrive as files; each micro-batch anti-joins what is annotated and appends replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxwright.operators.joins import todo_rows
from boxwright.operators.records import annotate, offline_annotator


def start(spark: SparkSession, incoming: str, schema: str, annotated: str, checkpoint: str, key: str, text: str, annotator=offline_annotator):
    """A running query. annotated: folder of (key, reply, error, failed) that grows; a restart goes on after the last whole batch."""

    def batch(df: DataFrame, _: int) -> None:
        kind = df.schema[key].dataType.simpleString()
        try:
            done = spark.read.parquet(annotated).select(key, "failed")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = spark.createDataFrame([], f"{key} {kind}, failed boolean")
        todo = todo_rows(df, done, [key])
        annotate(todo, key, text, annotator).selectExpr("*", "reply is null as failed").write.mode("append").parquet(annotated)

    return spark.readStream.schema(schema).parquet(incoming).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
