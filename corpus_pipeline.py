"""The corpus pipeline: each stage takes the documents that the stage before has kept, with decisions in effect.

1. toxicity: documents that the classifier chain rejects go.
2. line_dedup: lines that aren't the first of their class go from the texts; every document stays.
3. near_dedup: of documents tied by links of a similarity of 0.75 or more, the one with the smallest id stays.
4. decontamination: documents that hold a benchmark item go.
5. sentencepiece: what is left becomes token ids, decoded again for the record.

A null or empty text passes every stage (it has no words, lines or passages) and comes out without tokens; a row without id passes too and
is never taken for a copy. Rows that repeat an id are judged each by its own text; of rows that repeat id and text one stays. Columns
beside doc_id and text pass through. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxwright.llm.decontaminate import drop_leaks
from boxwright.llm.line_dedup import WHOLE, drop_lines
from boxwright.llm.near_dedup import drop_near_duplicates
from boxwright.llm.sentencepieces import round_trip
from boxwright.llm.shared import new_path, remove, table
from boxwright.llm.toxicity import drop_toxic, fit, label_categories


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels"), label_categories()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_lines(docs, **WHOLE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = round_trip(docs, model)
    return out.select("doc_id", "n_tokens", "ids_crc32", F.length("text").cast("long").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: SQL can express neither the fitted chain nor the edit join of lines; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)  # nothing reads the stage before any more
        docs, before = spark.read.parquet(path), path
    return docs
