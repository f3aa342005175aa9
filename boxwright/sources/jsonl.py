"""JSON Lines: scan with line numbers and a policy for bad rows, split sinks, lossless patching."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from boxwright.functions.text import key_text, norm_filename, safe_stem


def expand(spark: SparkSession, paths: str | list[str], suffixes: tuple[str, ...] = (".jsonl", ".jsonl.gz")) -> list[str]:
    """Files of paths, folders and globs in the order given, sorted within each folder and glob, each file once."""
    jvm, out = spark._jvm, []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(path)
        if not found:
            raise FileNotFoundError(p)
        for st in sorted(found, key=lambda st: st.getPath().toString()):
            if st.isDirectory():
                inside = sorted(x.getPath().toString() for x in fs.listStatus(st.getPath()) if x.isFile())
                out += [x for x in inside if x.endswith(suffixes)]
            else:
                out.append(st.getPath().toString())
    return list(dict.fromkeys(out))


def scan(spark: SparkSession, path: str | list[str], on_bad: str = "quarantine", schema: str | None = None, counts: Observation | None = None) -> DataFrame:
    """(file, file_no, line_no, raw, parse_error[, row]) for every line that isn't blank; line numbers count blank lines, from 1. Gzip by suffix.

    Files are numbered in the order of expand(). Lines are numbered in the parts that Spark splits a file into, and from counts of the parts
    before: no task reads a whole file but that of a gzip. on_bad: skip drops lines that are no JSON object; count drops and counts
    them; quarantine keeps them with parse_error set; raw keeps them with parse_error null, for a sink that takes lines as they are. counts
    observes rows_in, rows_ok and rows_bad as the result is first used."""
    files = expand(spark, path)
    numbers = spark.createDataFrame(list(enumerate(files)), "file_no int, listed string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    x = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"), F.col("value").alias("raw"))
    x = x.withColumn("_part", F.shiftright("_m", 33))
    sizes = x.groupBy("file", "_b", "_part").agg(F.count("*").alias("n"), F.min("_m").alias("lo"))
    ordered = F.array_sort(F.collect_list(F.struct("_b", "_part", "lo", "n")))  # a row for each split of a file
    parts = sizes.groupBy("file").agg(ordered.alias("p"))
    before = F.transform("p", lambda q, i: F.struct(q["_b"].alias("_b"), q["_part"].alias("_part"), (F.aggregate(F.slice("p", F.lit(1), i), F.lit(0).cast("long"), lambda s, y: s + y["n"]) - q["lo"]).alias("shift")))
    shifts = parts.select("file", F.explode(before).alias("q")).select("file", "q.*")
    x = x.join(F.broadcast(shifts), ["file", "_b", "_part"]).withColumn("line_no", (F.col("_m") + F.col("shift") + 1).cast("int"))
    x = x.join(F.broadcast(numbers), plain(F.col("file")) == plain(F.col("listed"))).select("file", "file_no", "line_no", "raw").where(~F.col("raw").rlike(r"(?U)^\s*$"))
    kind = F.schema_of_variant(F.try_parse_json("raw"))
    error = F.when(kind.isNull(), "bad_json").when(~kind.startswith("OBJECT"), "not_an_object")
    x = x.withColumn("parse_error", error)
    if counts is not None:
        x = x.observe(counts, F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("parse_error").isNull()).alias("rows_ok"), F.count_if(F.col("parse_error").isNotNull()).alias("rows_bad"))
    if on_bad in ("skip", "count"):
        x = x.where("parse_error is null")
    elif on_bad == "raw":
        x = x.withColumn("parse_error", F.lit(None).cast("string"))
    if schema:
        x = x.withColumn("row", F.from_json("raw", schema))
    return x


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Observation]:
    """df, and counts of its rows and of those that meet each condition, taken in the pass that first uses it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(k) for k, c in conditions.items())), seen


def line_count(spark: SparkSession, path: str | list[str]) -> int:
    return spark.read.text(expand(spark, path)).count()


def preview(df: DataFrame, n: int = 3) -> str:
    """Schema and first rows, as text."""
    rows = [json.loads(r[0]) for r in df.limit(n).select(F.to_json(F.struct("*"))).collect()]
    return json.dumps({"columns": {f.name: f.dataType.simpleString() for f in df.schema}, "rows": rows}, indent=2, ensure_ascii=False)


def target_list(spark: SparkSession, given: list[str] | None = None, file: str | None = None, default: list[str] | None = None) -> DataFrame:
    """(ord, target): names given, else the lines of a file that aren't blank, else the default ones."""
    names = given
    if not names and file:
        names = [r.value.strip() for r in spark.read.text(file).collect() if r.value.strip()]  # a list that a person keeps
    return spark.createDataFrame(list(enumerate(names or default or [])), "ord int, target string")


def rows_left(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What a run that goes on still has to do: rows whose keys no row of done has, nulls compared as empty."""
    k = [key_text(F.col(c).cast("string")).alias(f"_k{i}") for i, c in enumerate(keys)]
    cols = [f"_k{i}" for i in range(len(keys))]
    return df.select("*", *k).join(done.select(*k).distinct(), cols, "left_anti").select(*df.columns)


@F.pandas_udf(T.StringType())
def patched(raw: pd.Series, patch: pd.Series) -> pd.Series:
    """raw with the keys of patch (JSON text) added or replaced; keys in order, characters as they are."""
    return pd.Series([json.dumps(json.loads(r) | json.loads(p or "{}"), ensure_ascii=False) for r, p in zip(raw, patch, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def without_keys(raw: pd.Series, keys: pd.Series) -> pd.Series:
    """raw without the keys of a list."""
    return pd.Series([json.dumps({k: v for k, v in json.loads(r).items() if k not in set(gone)}, ensure_ascii=False) for r, gone in zip(raw, keys, strict=True)], dtype=object)


@F.pandas_udf(T.StringType())
def pretty(raw: pd.Series) -> pd.Series:
    """JSON with an indent of two, keys sorted."""
    return pd.Series([None if r is None else json.dumps(json.loads(r), indent=2, sort_keys=True, ensure_ascii=False) for r in raw], dtype=object)


def write_split(df: DataFrame, path: str, value: str = "raw", route: str = "_route", mode: str = "errorifexists") -> None:
    """One folder of lines for each value of the route, in one pass. mode append adds to what is there."""
    df.select(F.col(value).alias("value"), F.col(route).alias("route")).write.mode(mode).partitionBy("route").text(path)


def write_words(words: DataFrame, path: str, key: str = "doc_id") -> None:
    """JSON Lines of words in order, a folder for each document; documents are dealt out, so that each has one file."""
    fields = [c for c in words.columns if c != key]
    lines = words.select(key, "word_idx", F.to_json(F.struct(key, *fields), {"ignoreNullFields": "false"}).alias("value"))
    lines.repartition(key).sortWithinPartitions(key, "word_idx").select("value", key).write.partitionBy(key).text(path)


def json_report(df: DataFrame, **parts: Column) -> DataFrame:
    """One row with one JSON object: an aggregate for each key."""
    return df.agg(F.to_json(F.struct(*(c.alias(k) for k, c in parts.items())), {"ignoreNullFields": "false"}).alias("report"))


def pretty_stem(position: Column, filename: Column, by: str = "both") -> Column:
    """Name of a row's own file: its position in six digits, its file name, or both; unsafe characters become underscores."""
    number = F.coalesce(F.when(position.cast("string").rlike(r"^-?\d+$"), F.format_string("%06d", position.try_cast("long"))), position.cast("string"), F.lit("None"))
    name = F.when(F.coalesce(filename, F.lit("")) != "", norm_filename(filename)).otherwise(F.lit("no_filename"))
    return safe_stem({"idx": number, "filename": name}.get(by, F.concat(number, F.lit("_"), name)))


def write_pretty(df: DataFrame, path: str, stem: str, raw: str = "raw") -> None:
    """One folder for each stem with the row's indented JSON."""
    df.select(F.col(stem).alias("stem"), pretty(F.col(raw)).alias("value")).write.partitionBy("stem").text(path)


def pretty_array(df: DataFrame, order: list[str], raw: str = "raw") -> DataFrame:
    """(value): lines of one indented JSON array of all rows, in order; written in order of partitions by a text sink."""
    body = F.regexp_replace(pretty(F.col(raw)), "(?m)^", "  ")
    x = df.select(*order, body.alias("value")).withColumn("last", F.lit(0))
    ends = df.sparkSession.createDataFrame([(-1, "["), (1, "]")], "place int, value string")
    first = x.agg(F.max(F.struct(*order)).alias("m"))
    x = x.crossJoin(F.broadcast(first)).withColumn("value", F.when(F.struct(*order) == F.col("m"), F.col("value")).otherwise(F.concat("value", F.lit(","))))  # one row: the last place
    return x.select(F.lit(0).alias("place"), *order, "value").unionByName(ends, allowMissingColumns=True).orderBy("place", *order).select("value")


def file_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ocr): a row for each file, named by its stem."""
    x = spark.read.text(path, wholetext=True)
    return x.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("doc_id"), F.col("value").alias("ocr"))


def pick_columns(columns: list[str], wanted: dict[str, list[str]], overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Which column holds what: overrides first, else the first candidate that equals a column but for case and signs."""
    plain = lambda s: "".join(c for c in s.lower() if c.isalnum())
    have = {plain(c): c for c in reversed(columns)}
    found = {k: next((have[plain(c)] for c in names if plain(c) in have), None) for k, names in wanted.items()}
    return {k: v for k, v in (found | (overrides or {})).items() if v}
