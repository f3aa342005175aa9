"""Row policies of OCR verification: what comes in as rows with boxes goes out as rows with boxes, a route and a report by box.

`_route` says where a row goes: ok; bad (failed boxes); passed (nothing to check); missing (no OCR words). sinks() turns routes
into outputs. Metadata figures are rounded to four digits, those of the report to six, and name at most 200 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxwright.functions import geom, text as tx
from boxwright.operators.align import Options, match_labels, verify_boxes

#: Routes whose rows each policy writes to which output.
INFOVQA_SINKS = {"out": ("ok", "bad", "passed", "missing"), "fail": ("bad", "missing")}
DOCVQA_SINKS = {"out": ("ok",), "fail": ("bad", "missing", "no_image")}


def _clamped(b: Column) -> Column:
    return F.when(geom.is_box(b), F.transform(b, lambda v: geom.clamp(v.cast("double"), 0, 1000)))


def _document(image: Column) -> Column:
    return F.when(F.coalesce(image, F.lit("")) != "", tx.stem(image))


def _figures(digits: int) -> list[Column]:
    return [F.round(F.col(f"m.{k}"), digits).alias(k) for k in ("score", "coverage", "char_ratio", "iou", "dist")]


def verify_infovqa(rows: DataFrame, words: DataFrame, options: Options | None = None, digits: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows, report). rows: row_id, image, question, answer, possible_answers, bboxes array<struct<role, label, bbox, is_semantic>>.

    Extractive boxes with a label are matched: new_boxes has the OCR box where that passes (status verified or corrected), answers that fail as
    they were (failed), and no other box that fails. A failed answer makes the row bad, unless it asks "how many" and as many
    answer boxes are left as its answer says. Rows without image or boxes pass unchanged; rows without words pass, and are missing.
    """
    x = rows.withColumn("doc_id", F.when(F.col("bboxes").isNotNull(), _document(F.col("image"))))
    boxes = x.where("doc_id is not null").select("row_id", "doc_id", F.posexplode("bboxes").alias("box_no", "b"))
    boxes = boxes.select("row_id", "doc_id", "box_no", "b", F.array(F.coalesce("b.label", F.lit(""))).alias("labels"), _clamped(F.col("b.bbox")).alias("pred_box"), F.col("b.role").alias("role"), F.col("b.is_semantic").alias("is_semantic"))
    done = verify_boxes(match_labels(boxes, words, options))
    box = F.when(F.col("status").isin("verified", "corrected"), geom.round_box(F.col("m.box"), digits)).otherwise(F.col("b.bbox"))
    source = F.when(F.col("status").isin("verified", "corrected"), "ocr").when(F.col("status") == "failed", "gemini")
    why = F.when(F.col("status").isin("verified", "corrected", "failed"), F.col("m.reason"))
    meta = F.struct(source.alias("bbox_source"), F.when(source.isNotNull(), F.col("status")).alias("ocr_status"), why.alias("ocr_reason"), *_figures(4), F.slice("m.words", 1, 200).alias("matched_words"))
    made = F.struct("box_no", "b.role", "b.label", box.alias("bbox"), "b.is_semantic", F.when(source.isNotNull(), meta).alias("meta"))
    kept = F.when(F.col("status") != "dropped", made)
    answers = F.count_if((F.col("status") != "dropped") & F.coalesce(F.col("role") == "answer", F.lit(False)))
    per_row = done.groupBy("row_id").agg(F.array_sort(F.collect_list(kept)).alias("new_boxes"), F.bool_or(F.col("status") == "failed").alias("fails"), answers.alias("answers"))
    known = words.select("doc_id").distinct().withColumn("has_words", F.lit(True))
    x = x.join(per_row, "row_id", "left").join(known, "doc_id", "left")
    candidates = F.concat(F.array("answer"), F.coalesce("possible_answers", F.array().cast("array<string>")))
    asked = F.when(tx.asks_how_many(F.col("question")), F.coalesce(tx.first_number(F.filter(candidates, lambda s: F.trim(s) != "")), F.lit(-1)))
    bad = F.coalesce("fails", F.lit(False)) & ~F.coalesce(asked == F.col("answers"), F.lit(False))
    route = F.when(F.col("doc_id").isNull(), "passed").when(F.col("has_words").isNull(), "missing").when(bad, "bad").otherwise("ok")
    reason = F.when(route == "missing", "missing_ocr_word_jsonl").when(route == "bad", "failed_answer_box")
    out = x.withColumn("_route", route).withColumn("_reason", reason).drop("fails", "answers", "has_words", "doc_id")
    seen = done.where("status <> 'passed'")
    action = F.when(F.col("status") == "dropped", "removed_non_answer")
    report = seen.select("row_id", F.col("box_no").alias("bbox_idx"), "role", F.get("labels", F.lit(0)).alias("label"), "pred_box", F.col("m.ok").alias("ok"), "m.reason", *_figures(6), geom.round_box(F.col("m.box"), digits).alias("corrected_bbox"), F.slice("m.words", 1, 200).alias("matched_words"), action.alias("action"))
    return out, report


def correct_docvqa(rows: DataFrame, words: DataFrame, options: Options | None = None, input_format: str = "auto", output_format: str = "same", digits: int = 2, whole_pixels: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, report). rows: row_id, image, width, height, answer, possible_answers, boxes array<struct<label, bbox>> (label null for bare boxes).

    Every readable box is matched with its own label first, then the answers; the box of the best passing label counts, or else of the
    best of all. Any failed box makes the row bad. Boxes that can't be read stay. input_format: pixel, norm1000 or auto (a large image whose
    numbers stay within 1000 is norm1000); output_format: the same, pixel or norm1000. Rows without image are no_image, without words missing.
    """
    o = options or Options(by_line_cluster=False)
    x = rows.withColumn("doc_id", _document(F.col("image")))
    x = x.withColumn("_all", tx.label_texts(F.col("answer"), F.col("possible_answers"))).withColumn("_keys", tx.norm_list("_all"))
    x = x.withColumn("_labels", tx.label_candidates(F.col("_all"), F.col("_keys"))).drop("_all", "_keys")
    boxes = x.where("doc_id is not null").select("row_id", "doc_id", "width", "height", "_labels", F.posexplode("boxes").alias("box_no", "b"))
    own = tx.strip(F.col("b.label"))
    others = F.filter("_labels", lambda s: tx.strip(F.lower(s)) != tx.strip(F.lower(own)))
    labels = F.when(F.coalesce(own, F.lit("")) != "", F.concat(F.array(own), others)).otherwise(F.col("_labels"))
    kind = geom.detected_format(F.col("b.bbox"), F.col("width"), F.col("height")) if input_format == "auto" else F.lit(input_format)
    pred = F.when(kind == "norm1000", _clamped(F.col("b.bbox"))).otherwise(geom.pixel_to_norm1000(F.col("b.bbox"), F.col("width"), F.col("height")))
    boxes = boxes.select("row_id", "doc_id", "box_no", "width", "height", "b", kind.alias("kind"), labels.alias("labels"), pred.alias("pred_box"), geom.is_box(F.col("b.bbox")).alias("readable"))
    done = match_labels(boxes.where("readable"), words, o).unionByName(boxes.where("not readable"), allowMissingColumns=True)
    done = done.withColumn("fails", F.col("readable") & F.col("m").isNotNull() & ~F.coalesce(F.col("m.ok"), F.lit(False)))
    to = F.col("kind") if output_format == "same" and input_format == "auto" else F.lit(input_format if output_format == "same" else output_format)
    pixel = F.coalesce(geom.norm1000_out(F.col("m.box"), F.col("width"), F.col("height"), whole_pixels), F.col("b.bbox"))
    good = F.col("readable") & F.coalesce(F.col("m.ok"), F.lit(False))
    box = F.when(good & (to == "norm1000"), geom.round_box(F.col("m.box"), digits)).when(good, pixel).otherwise(F.col("b.bbox"))
    status = F.when(good, F.col("m.reason")).when(F.col("fails"), "failed")
    meta = F.struct(status.alias("ocr_status"), F.when(F.col("fails"), F.col("m.reason")).alias("ocr_fail_reason"), F.col("used_label").alias("ocr_used_label"), *_figures(4))
    per_row = done.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("box_no", "b.label", box.alias("bbox"), F.when(status.isNotNull(), meta).alias("meta")))).alias("new_boxes"), F.bool_or("fails").alias("fails"))
    known = words.select("doc_id").distinct().withColumn("has_words", F.lit(True))
    x = x.join(per_row, "row_id", "left").join(known, "doc_id", "left")
    route = F.when(F.col("doc_id").isNull(), "no_image").when(F.col("has_words").isNull(), "missing").when(F.coalesce("fails", F.lit(False)), "bad").otherwise("ok")
    reason = F.when(route == "no_image", "missing_image_field").when(route == "missing", "missing_ocr_word_jsonl").when(route == "bad", "failed_box")
    out = x.withColumn("_route", route).withColumn("_reason", reason).drop("fails", "has_words", "doc_id", "_labels")
    report = done.where("readable and m is not null").select("row_id", F.col("box_no").alias("box_idx"), F.col("b.bbox").alias("pred_bbox"), geom.round_box(F.col("pred_box"), 2).alias("pred_bbox_norm"), F.col("m.ok").alias("ok"), "m.reason", "used_label", *_figures(6), geom.round_box(F.col("m.box"), 2).alias("corrected_bbox_norm"))
    return out, report


def sinks(rows: DataFrame, outputs: dict[str, tuple[str, ...]], route: str = "_route") -> DataFrame:
    """rows with `_sink`: a copy of each row for every output that takes its route."""
    names = F.array_compact(F.array(*(F.when(F.col(route).isin(list(routes)), F.lit(name)) for name, routes in outputs.items())))
    return rows.withColumn("_sink", F.explode(names))
