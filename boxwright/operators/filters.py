"""Row filters and splits. A split adds `_route` (ok or bad) and `_reason`; nothing is written before a sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from boxwright.functions import geom


def aspect_ratio(df: DataFrame, threshold: float = 4.0, width: str = "width", height: str = "height") -> DataFrame:
    """Rows with usable sizes, routed by max(w/h, h/w) > threshold. Rows without positive sizes go. NaN is kept."""
    w, h = F.col(width).cast("double"), F.col(height).cast("double")
    r = F.greatest(w / F.nullif(h, F.lit(0.0)), h / F.nullif(w, F.lit(0.0)))
    x = df.where((w > 0) & (h > 0)).withColumn("aspect_ratio", r)
    bad = (F.col("aspect_ratio") > threshold) & ~F.isnan("aspect_ratio")
    return x.withColumn("_route", F.when(bad, "bad").otherwise("ok")).withColumn("_reason", F.when(bad, f"ratio>{threshold}"))


def area_ratio(df: DataFrame, threshold: float = 0.2, keep_empty_rows: bool = False, boxes: str = "bboxs", width: str = "width", height: str = "height") -> DataFrame:
    """Keeps boxes of at most that share of the image, as they were; rows without any left are bad. Adds the kept boxes and ratios,
    and the places of dropped ones. Rows without positive sizes go; boxes that aren't boxes count as dropped."""
    w, h = F.col(width).cast("double"), F.col(height).cast("double")
    x = df.where((w > 0) & (h > 0))
    rated = F.transform(F.coalesce(F.col(boxes), F.array().cast("array<array<double>>")), lambda b, i: F.struct(i.alias("i"), b.alias("b"), geom.area_ratio(b, w, h).alias("r")))
    ok = lambda v: F.coalesce(v["r"] <= threshold, F.lit(False))
    x = x.withColumn("_rated", rated).withColumn("_kept", F.filter("_rated", ok))
    x = x.withColumn("kept_boxes", F.transform("_kept", lambda v: v["b"])).withColumn("kept_bbox_ratios", F.transform("_kept", lambda v: v["r"]))
    x = x.withColumn("dropped_bbox_indices", F.transform(F.filter("_rated", lambda v: ~ok(v)), lambda v: v["i"]))
    bad = (F.size("kept_boxes") == 0) & F.lit(not keep_empty_rows)
    return x.withColumn("_route", F.when(bad, "bad").otherwise("ok")).withColumn("_reason", F.when(bad, "no_boxes_left")).drop("_rated", "_kept")


def box_agreement(df: DataFrame, threshold: float = 0.9, boxes: str = "bboxs") -> DataFrame:
    """Rows whose boxes don't agree are bad: mean pairwise overlap below the threshold, no boxes, or fewer than two usable ones.
    A single box is accepted as it is."""
    b = F.col(boxes)
    n = F.coalesce(F.size(b), F.lit(0))
    usable = F.filter(b, geom.is_box)
    x = df.withColumn("mean_pairwise_iou", F.when((n > 1) & (F.size(usable) >= 2), geom.mean_pairwise_iou(usable)))
    reason = F.when(n <= 0, "missing_or_empty_bboxs").when(n == 1, None).when(F.size(usable) < 2, "invalid_bboxs_after_parsing").when(F.col("mean_pairwise_iou") < threshold, f"mean_pairwise_iou<{threshold}")
    return x.withColumn("_reason", reason).withColumn("_route", F.when(F.col("_reason").isNull(), "ok").otherwise("bad"))


def box_agreement_by_image(df: DataFrame, threshold: float = 0.9, boxes: str = "bboxs", image: str = "image") -> DataFrame:
    """As box_agreement, but one bad row makes all rows of its image bad. Rows without image stand alone.

    The flag of an image is aggregated map-side and joined back, so that an image with very many rows is never sorted in one task."""
    x = box_agreement(df, threshold, boxes)
    poor = x.where((F.col("_route") == "bad") & F.col(image).isNotNull()).select(F.col(image).alias("_image")).distinct()
    x = x.join(poor, x[image] == poor["_image"], "left")
    return x.withColumn("_route", F.when(F.col("_image").isNotNull(), "bad").otherwise(F.col("_route"))).drop("_image")


def coercible_box_reason(v: Column) -> Column:
    """Why a VARIANT item isn't a box whose coordinates can be read as numbers (numeric strings can); null if it is."""
    kind = F.schema_of_variant(v)
    box = F.try_variant_get(v, "$.bbox", "variant")
    box_kind = F.schema_of_variant(box)
    numbers = F.try_variant_get(box, "$", "array<string>")
    bad_number = F.exists(numbers, lambda s: s.isNull() | ~F.lower(F.trim(s)).rlike(NUMBER))
    named = [F.try_variant_get(box, f"$.{k}", "string") for k in ("ymin", "xmin", "ymax", "xmax")]
    return (
        F.when(~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), "bbox_item_not_dict")
        .when(box_kind.startswith("ARRAY") & (F.size(numbers) != 4), "bbox_list_len!=4")
        .when(box_kind.startswith("ARRAY") & bad_number, "bbox_list_non_numeric")
        .when(box_kind.startswith("ARRAY"), None)
        .when(box_kind.startswith("OBJECT") & F.greatest(*(x.isNull() for x in named)), "bbox_dict_missing_keys")
        .when(box_kind.startswith("OBJECT") & F.greatest(*(~F.lower(F.trim(x)).rlike(NUMBER) for x in named)), "bbox_dict_non_numeric")
        .when(box_kind.startswith("OBJECT"), None)
        .otherwise("bbox_wrong_type")
    )


#: What reads as a number: digits with an optional sign, point and exponent; infinities, NaN; and booleans, which count as 0 and 1.
NUMBER = r"^([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?(inf|infinity|nan)|true|false)$"


def box_validity(df: DataFrame, boxes: str = "bboxes") -> DataFrame:
    """boxes: JSON text. Adds `_reasons` (empty for valid rows, an empty list of boxes among them) and `_route`."""
    v = F.try_parse_json(boxes)
    listed = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    reasons = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), coercible_box_reason), lambda r: r.isNotNull())
    x = df.withColumn("_reasons", F.when(listed, reasons).otherwise(F.array(F.lit("bboxes_not_a_list_or_missing"))))
    return x.withColumn("_route", F.when(F.size("_reasons") == 0, "ok").otherwise("bad"))


def read_box(v: Column) -> Column:
    """A VARIANT box, list (y, x, y, x) or object with ymin, xmin, ymax, xmax, as ARRAY<DOUBLE>; null if it is neither."""
    as_list = F.try_variant_get(v, "$", "array<double>")
    as_object = F.array(*(F.try_variant_get(v, f"$.{k}", "double") for k in ("ymin", "xmin", "ymax", "xmax")))
    return F.when(geom.is_box(as_list), as_list).when(geom.is_box(as_object), as_object)


def fix_box_format(df: DataFrame, boxes: str = "bboxes") -> DataFrame:
    """boxes: JSON text of items {bbox: list or object}, or bare boxes. Unreadable boxes go. Adds `boxes_yxyx` and, in the other order, `boxes_xyxy`."""
    items = F.try_variant_get(F.try_parse_json(boxes), "$", "array<variant>")
    read = F.filter(F.transform(items, lambda v: F.coalesce(read_box(F.try_variant_get(v, "$.bbox", "variant")), read_box(v))), lambda b: b.isNotNull())
    x = df.withColumn("boxes_yxyx", F.coalesce(read, F.array().cast("array<array<double>>")))
    return x.withColumn("boxes_xyxy", F.transform("boxes_yxyx", geom.reorder))


def strict_box(v: Column) -> Column:
    """Four JSON numbers (booleans count), no strings."""
    items = F.try_variant_get(v, "$", "array<variant>")
    number = lambda x: F.coalesce(F.schema_of_variant(x).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), F.lit(False))
    return F.coalesce((F.size(items) == 4) & F.forall(items, number), F.lit(False))


def annotation_success(answer_type: Column, boxes_json: Column) -> Column:
    """A known answer type, and boxes that all have a role, a label, a box of four numbers and a semantic flag. No boxes pass."""
    v = F.try_parse_json(boxes_json)
    items = F.try_variant_get(v, "$", "array<variant>")
    has = lambda x, k: F.try_variant_get(x, f"$.{k}", "variant").isNotNull()
    good = lambda x: has(x, "role") & has(x, "label") & has(x, "is_semantic") & strict_box(F.try_variant_get(x, "$.bbox", "variant"))
    return F.coalesce(answer_type.isin("extractive", "semantic") & F.schema_of_variant(v).startswith("ARRAY") & F.forall(items, good), F.lit(False))


def annotation_failed(boxes_json: Column) -> Column:
    """Whether a row's boxes are no list or an empty one."""
    v = F.try_parse_json(boxes_json)
    listed = F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    return ~listed | (F.size(F.try_variant_get(v, "$", "array<variant>")) == 0)


def ocr_failed(boxes_json: Column) -> Column:
    """Whether any box object has the status failed, in any case. What isn't a list has no failed box."""
    items = F.try_variant_get(F.try_parse_json(boxes_json), "$", "array<variant>")
    return F.coalesce(F.exists(items, lambda x: F.coalesce(F.lower(F.try_variant_get(x, "$.ocr_status", "string")) == "failed", F.lit(False))), F.lit(False))


def most_rows(df: DataFrame, n: int, by: str | None = None, order: str = "row_id") -> DataFrame:
    """The first n rows, of each value of `by` if given."""
    if by is None:
        return df.orderBy(order).limit(n)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
