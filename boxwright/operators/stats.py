"""Box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxwright.functions import geom


def box_count(df: DataFrame, boxes: str = "bboxs") -> DataFrame:
    """Adds n_boxes: items of four; a null list has none."""
    return df.withColumn("n_boxes", F.coalesce(F.size(F.filter(boxes, lambda b: F.coalesce(F.size(b) == 4, F.lit(False)))), F.lit(0)))


def boxes_per_row(raw: Column) -> Column:
    """Number of boxes of a row in JSON: bboxs counts if it is a list; else bboxes, of objects with a bbox or of lists; items of four count."""
    v = F.try_parse_json(raw)
    listed = lambda x: F.coalesce(F.schema_of_variant(x).startswith("ARRAY"), F.lit(False))
    items = lambda k: F.try_variant_get(v, f"$.{k}", "array<variant>")
    four = lambda x: listed(x) & F.coalesce(F.size(F.try_variant_get(x, "$", "array<variant>")) == 4, F.lit(False))
    of = lambda xs, f: F.size(F.filter(xs, lambda x: F.coalesce(f(x), F.lit(False))))
    objects = F.forall(items("bboxes"), lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    own, other = F.try_variant_get(v, "$.bboxs", "variant"), F.try_variant_get(v, "$.bboxes", "variant")
    dicts = of(items("bboxes"), lambda x: four(F.try_variant_get(x, "$.bbox", "variant")))
    return F.when(listed(own), of(items("bboxs"), four)).when(listed(other) & objects, dicts).when(listed(other), of(items("bboxes"), four)).otherwise(0)


def best_first(df: DataFrame, key: str, score: str, order: str) -> DataFrame:
    """Of each key the row with the highest score, of equal ones the first by order; aggregated before rows move."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.col(score), (-F.col(order)).alias("o")))
    return df.groupBy(F.col(key).alias("_key")).agg(best.alias("b")).select("b.*")


def count_summary(df: DataFrame, count: str = "n_boxes") -> DataFrame:
    """One row: rows, min, max, mean, exact linear percentiles, rows without boxes and their share in per cent."""
    q = F.percentile(count, F.array(*map(F.lit, (0.25, 0.5, 0.75, 0.9, 0.95, 0.99))))
    x = df.agg(F.count("*").alias("n_rows"), F.min(count).cast("long").alias("least"), F.max(count).cast("long").alias("most"), F.avg(count).alias("mean"), q.alias("q"), F.count_if(F.col(count) == 0).alias("num_zero"))
    names = ("p25", "median", "p75", "p90", "p95", "p99")
    return x.select("n_rows", "least", "most", F.round("mean", 6).alias("mean"), *(F.round(F.get("q", F.lit(i)), 6).alias(k) for i, k in enumerate(names)), "num_zero", F.round(F.col("num_zero") * 100.0 / F.nullif("n_rows", F.lit(0)), 6).alias("pct_zero"))


def count_histogram(df: DataFrame, count: str = "n_boxes", max_k: int = 30) -> DataFrame:
    """Rows for each count 0..max_k, also where there are none, and one row max_k + 1 for all larger counts."""
    got = df.groupBy(F.least(F.col(count), F.lit(max_k + 1)).cast("long").alias("k")).agg(F.count("*").alias("n"))
    bins = df.sparkSession.range(max_k + 2).withColumnRenamed("id", "k")
    return bins.join(got, "k", "left").select("k", F.coalesce("n", F.lit(0)).alias("n"))


def ratios(df: DataFrame, mode: str = "per_bbox", boxes: str = "bboxs", width: str = "width", height: str = "height") -> DataFrame:
    """Area ratios, clamped to 0..1, of each box (per_bbox), or their sum or maximum by row. Boxes without area don't count."""
    rated = F.filter(F.transform(boxes, lambda b: geom.area_ratio(b, F.col(width), F.col(height))), lambda r: r > 0)
    one = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    if mode == "per_bbox":
        return df.select(F.explode(rated).alias("ratio")).select(one(F.col("ratio")).alias("ratio"))
    total: Column = F.aggregate(rated, F.lit(0.0), lambda s, r: s + r) if mode == "per_row_sum" else F.array_max(rated)
    return df.where(F.size(rated) > 0).select(one(total).alias("ratio"))


def ratio_histogram(r: DataFrame, step: float = 0.05) -> DataFrame:
    """Counts in bins [i * step, (i + 1) * step) of exact doubles; the last edge is 1, so that 1 itself has a bin of no width."""
    import math

    n = math.ceil((1.0 + step) / step)
    edges = [i * step for i in range(n)]
    edges = edges if edges[-1] >= 1.0 + step / 2 else [*edges, n * step]
    edges = [e for e in edges if e < 1.0 + step + 1e-9]
    edges[-1] = 1.0
    bins = [(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)]
    which = F.lit(None).cast("int")
    for i, lo, hi in reversed(bins):
        inside = (F.col("ratio") >= lo) & ((F.col("ratio") < hi) | (F.lit(i == len(bins) - 1) & (F.col("ratio") <= hi)))
        which = F.when(inside, i).otherwise(which)
    got = r.groupBy(which.alias("bin")).agg(F.count("*").alias("n"))
    table = r.sparkSession.createDataFrame(bins, "bin int, bin_left double, bin_right double")
    return table.join(got, "bin", "left").select("bin", "bin_left", "bin_right", F.coalesce("n", F.lit(0)).alias("n"))


def ratio_percentiles(r: DataFrame) -> DataFrame:
    points = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
    q = r.agg(F.percentile("ratio", F.array(*map(F.lit, points))).alias("q"))
    return q.select(F.explode(F.arrays_zip(F.array(*(F.lit(int(p * 100)) for p in points)).alias("percent"), F.col("q").alias("value"))).alias("x")).select("x.percent", F.round("x.value", 6).alias("value"))
