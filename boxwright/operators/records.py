"""Projections of nested records: video clips, slides, chain-of-thought rows, model replies, drawing plans."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from boxwright.functions import geom
from boxwright.functions.text import deck_id, json_object_in, page_numbers, stem, strip, strip_label


def structure_clips(df: DataFrame, strip_prefix: bool = True, sort: bool = True, clips: str = "clips") -> DataFrame:
    """Clips as (clip_id, span [start, end], caption), sorted by clip id, then start (both last where missing), then place."""
    text = lambda c: strip_label(c["main_caption"], "main caption") if strip_prefix else c["main_caption"]
    made = F.transform(
        F.filter(clips, lambda c: c.isNotNull()),
        lambda c, i: F.struct(F.coalesce(c["clip_id"].cast("double"), F.lit(1e18)).alias("o1"), F.coalesce(c["start_time"].cast("double"), F.lit(float("inf"))).alias("o2"), i.alias("o3"), c["clip_id"].alias("clip_id"), F.array(c["start_time"], c["end_time"]).alias("span"), text(c).alias("caption")),
    )
    made = F.array_sort(made) if sort else made
    return df.withColumn(clips, F.transform(made, lambda c: F.struct(c["clip_id"], c["span"], c["caption"]))).withColumn("num_clips", F.size(clips))


def slide_rows(df: DataFrame, qid: str = "qid", evidence: str = "evidence", pages: str = "num_pages", deck: str = "deck_id", prefix: str = "page_", ext: str = "jpg") -> DataFrame:
    """Question rows with evidence pages as numbers, a deck id (made from the question where missing) and a path for each page."""
    x = df.withColumn("evidence_pages", page_numbers(F.col(evidence)))
    x = x.withColumn("deck_id", deck_id(F.nullif(strip(F.col(deck).cast("string")), F.lit("")), F.col(qid), F.lit(0)))
    n = F.coalesce(F.col(pages), F.lit(0)).cast("int")
    paths = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda j: F.concat(F.col("deck_id"), F.format_string(f"/{prefix}%02d.{ext}", j)))).otherwise(F.array().cast("array<string>"))
    return x.withColumn("pages", paths)


def cot_rows(df: DataFrame, images: str = "image", turns: str = "conversations") -> DataFrame:
    """From (paths with ###[box] tails, turns): image path, pixel boxes, question without its request for a box, last answer that
    isn't a box, and the first normalised box that the model names."""
    tail = lambda s: F.from_json(F.substring_index(s, "###", -1), "array<double>")
    boxes = F.filter(F.transform(F.filter(images, lambda s: F.contains(s, F.lit("###"))), tail), geom.is_box)
    said = lambda who: F.transform(F.filter(turns, lambda t: t["from"] == who), lambda t: strip(t["value"]))
    asked = F.get(said("human"), F.lit(0))
    asked = strip(F.get(F.split(F.regexp_replace(asked, r"<image>\s*", ""), r"\s+Please provide", 2), F.lit(0)))
    lists = F.filter(F.transform(said("gpt"), lambda v: F.from_json(v, "array<double>")), geom.is_box)
    words = F.filter(said("gpt"), lambda v: ~v.startswith("["))
    return df.select("*", F.substring_index(F.get(images, F.lit(0)), "###", 1).alias("path"), boxes.alias("boxes"), asked.alias("question"), F.try_element_at(words, F.lit(-1)).alias("answer"), F.get(lists, F.lit(0)).alias("norm_box"))


def unified_rows(df: DataFrame, image: str = "image", boxes: str = "bboxs", images: str = "images", turns: str = "conversations", width: str = "width", height: str = "height") -> DataFrame:
    """Rows of both shapes as (path, boxes, question, answer) in pixels: a row with a question and boxes as it is; one with turns by cot_rows(),
    where the normalised box that the model names stands in if no image path has a box."""
    made = cot_rows(df.drop("boxes", "path").withColumnsRenamed({"question": "_q", "answer": "_a"}), images, turns)
    plain = F.col("_q").isNotNull() & F.col(boxes).isNotNull()
    fallback = geom.norm1_to_pixel(F.col("norm_box"), F.col(width), F.col(height))
    own = F.when(F.size("boxes") > 0, F.col("boxes")).when(fallback.isNotNull(), F.array(fallback)).otherwise(F.array().cast("array<array<double>>"))
    out = made.withColumns({"path": F.when(plain, F.col(image)).otherwise(F.col("path")), "boxes": F.when(plain, F.col(boxes)).otherwise(own), "question": F.when(plain, F.col("_q")).otherwise(F.col("question")), "answer": F.when(plain, F.col("_a")).otherwise(F.col("answer"))})
    return out.drop("_q", "_a")


# The figures of a model's usage report.
USAGE = ["prompt_token_count", "candidates_token_count", "total_token_count", "thoughts_token_count", "cached_content_token_count", "tool_use_prompt_token_count"]


def token_usage(usage: Column) -> Column:
    """Known figures of a usage report (JSON) that aren't null, as a map; null where there are none."""
    v = F.try_parse_json(usage)
    every = F.create_map(*(x for k in USAGE for x in (F.lit(k), F.try_variant_get(v, f"$.{k}", "bigint"))))
    some = F.map_filter(every, lambda k, n: n.isNotNull())
    return F.when(F.size(some) > 0, some)


def payload(df: DataFrame) -> DataFrame:
    """The five fields that a model call gets; texts that are missing are empty."""
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in ("question", "answer", "image")]
    size = [F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in ("width", "height")]
    return df.select(*text, *size)


def numbered(raw: Column, line_no: Column) -> Column:
    """A row's own line_no where its JSON has the key (also as null), else its place in the file."""
    v = F.try_parse_json(raw)
    has = F.coalesce(F.array_contains(F.json_object_keys(raw), "line_no"), F.lit(False))
    return F.when(has, F.try_variant_get(v, "$.line_no", "bigint")).otherwise(line_no.cast("long"))


def draw_plan(df: DataFrame, row_no: str, image: str, boxes: str = "bboxes", width: str = "width", height: str = "height") -> DataFrame:
    """A row for each box to draw: file name, number, corners in whole pixels, colour by role, legend. boxes: structs (role, label, bbox)."""
    x = df.select(F.format_string("%06d__%s.png", F.col(row_no).cast("long"), stem(F.col(image))).alias("out_name"), F.col(width).alias("_w"), F.col(height).alias("_h"), F.posexplode(boxes).alias("box_no", "b"))
    x = x.withColumn("d", geom.draw_box(F.col("b.bbox"), F.col("_w"), F.col("_h"))).where("d is not null")
    corner = lambda i, k: F.get("d", F.lit(i)).cast("int").alias(k)
    return x.select("out_name", "box_no", corner(0, "x1"), corner(1, "y1"), corner(2, "x2"), corner(3, "y2"), F.when(F.col("b.role") == "answer", "green").otherwise("red").alias("color"), F.concat_ws(": ", "b.role", "b.label").alias("legend"))


def seed_boxes(boxes: Column, most: int = 50) -> Column:
    """The first `most` valid boxes."""
    return F.slice(F.filter(boxes, geom.is_box), 1, most)


def refined_boxes(reply: Column) -> Column:
    """Boxes of a reply's JSON object, with defaults: role context, empty label, is_semantic false."""
    items = F.try_variant_get(F.try_parse_json(json_object_in(reply)), "$.bboxes", "array<variant>")
    get = lambda v, k, t: F.try_variant_get(v, f"$.{k}", t)
    made = F.transform(items, lambda v: F.struct(F.coalesce(get(v, "role", "string"), F.lit("context")).alias("role"), F.coalesce(get(v, "label", "string"), F.lit("")).alias("label"), get(v, "bbox", "array<double>").alias("bbox"), F.coalesce(get(v, "is_semantic", "boolean"), F.lit(False)).alias("is_semantic")))
    return F.filter(made, lambda b: geom.is_box(b["bbox"]))


def prompt(question: Column, seeds: Column) -> Column:
    return F.concat(F.lit("Question: "), F.coalesce(question, F.lit("")), F.lit("\nKnown boxes (ymin, xmin, ymax, xmax in 0..1000): "), F.to_json(seeds), F.lit("\nReply with one JSON object with answer_type and bboxes."))


def offline_annotator(text: str) -> str:
    """Stands in for a model: the boxes of the prompt come back as context boxes."""
    import json
    import re

    m = re.search(r"0\.\.1000\): (\[.*\])\n", text)
    boxes = json.loads(m[1]) if m else []
    return json.dumps({"answer_type": "extractive", "bboxes": [{"role": "context", "label": "", "bbox": b} for b in boxes]})


def annotate(df: DataFrame, key: str, text: str, annotator: Callable[[str], str] = offline_annotator, threads: int = 8, max_retries: int = 5, base_sleep: float = 0.8, path: str | None = None) -> DataFrame:
    """(key, reply, error): one call for each row, in a pool of threads for each task; failed calls are repeated with growing waits.

    With a path, replies are written there and read back, so that whatever uses them later never calls again, also if an executor is lost.

    A reply that can't be parsed is not asked for again; that is left to the caller."""

    def call(prompt_: str) -> tuple[str | None, str | None]:
        why = None
        for attempt in range(max_retries + 1):
            try:
                return annotator(prompt_), None
            except Exception as e:  # noqa: BLE001  the annotator is foreign code
                why = f"{type(e).__name__}: {e}"
                if attempt < max_retries:
                    time.sleep(base_sleep * 2**attempt * random.uniform(0.7, 1.3))
        return None, why

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in batches:
                got = list(pool.map(call, pdf["t"]))
                yield pd.DataFrame({"key": pdf["key"], "reply": [a for a, _ in got], "error": [b for _, b in got]})

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInPandas(run, f"key {kind}, reply string, error string").withColumnRenamed("key", key)
    if path is None:
        return out
    out.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def merge_replies(df: DataFrame, replies: DataFrame, key: str, seeds: str = "seed_boxes", keep_seeds: bool = True) -> DataFrame:
    """Rows with the reply's boxes; without a readable reply their seeds as context boxes (or, without keep_seeds, none); answer_type, `_route`."""
    x = df.join(replies, key, "left")
    made = refined_boxes(F.col("reply"))
    own = F.transform(seeds, lambda b: F.struct(F.lit("context").alias("role"), F.lit("").alias("label"), b.alias("bbox"), F.lit(False).alias("is_semantic")))
    kind = F.try_variant_get(F.try_parse_json(json_object_in(F.col("reply"))), "$.answer_type", "string")
    return x.withColumn("bboxes", F.coalesce(made, own if keep_seeds else F.slice(own, 1, 0))).withColumn("answer_type", kind).withColumn("_route", F.when(made.isNull(), "bad").otherwise("ok")).drop("reply", "error")
