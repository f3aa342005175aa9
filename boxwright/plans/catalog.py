"""One query for each operator over the derived inputs, with the same in SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from boxwright.functions import geom, text as tx
from boxwright.operators import align, filters, joins, ocr, policies, records, stats
from boxwright.plans.adapters import BOXES_SQL, FILES_SQL, WORDS_SQL, ocr_words, pixel_boxes, table, url_files, vqa_pixel

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def six(c):
    return F.round(c, 6) + F.lit(0.0)


PAIRS = f"""with {BOXES_SQL},
pr as (select p.row_id, greatest(least(p.x2, q.x2) - greatest(p.x1, q.x1), 0) * greatest(least(p.y2, q.y2) - greatest(p.y1, q.y1), 0) as i,
  (p.x2 - p.x1) * (p.y2 - p.y1) as a, (q.x2 - q.x1) * (q.y2 - q.y1) as c from b p join b q on p.row_id = q.row_id and p.k < q.k),
m as (select row_id, avg(case when a + c - i > 0 then i / (a + c - i) else 0 end) as iou from pr group by 1),
r as (select row_id, image, count(*) as n from b group by 1, 2),
s as (select r.row_id, image, n, iou, n > 1 and iou < 0.9 as bad from r left join m using (row_id))"""


@query(f"{PAIRS} select row_id, image, n::bigint as n_boxes, round(iou, 6) as mean_iou, case when bad then 'bad' else 'ok' end as route, case when bad then 'mean_pairwise_iou<0.9' end as reason from s")
def box_agreement_rows(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.box_agreement(vqa_pixel(spark, sf))
    return x.select("row_id", "image", F.size("bboxs").cast("long").alias("n_boxes"), F.round("mean_pairwise_iou", 6).alias("mean_iou"), F.col("_route").alias("route"), F.col("_reason").alias("reason"))


@query(f"{PAIRS} select row_id, image, case when bool_or(bad) over (partition by image) then 'bad' else 'ok' end as route from s")
def box_agreement_images(spark: SparkSession, sf: str) -> DataFrame:
    return filters.box_agreement_by_image(vqa_pixel(spark, sf)).select("row_id", "image", F.col("_route").alias("route"))


NORM = f"""with {BOXES_SQL}, c as (select *, greatest(least(x1, width), 0) as a1, greatest(least(y1, height), 0) as b1, greatest(least(x2, width), 0) as a2, greatest(least(y2, height), 0) as b2 from b),
n as (select *, round(b1 * 1000.0::double / height + 1e-12, 2) as ny1, round(a1 * 1000.0::double / width + 1e-12, 2) as nx1, round(b2 * 1000.0::double / height + 1e-12, 2) as ny2, round(a2 * 1000.0::double / width + 1e-12, 2) as nx2 from c)"""
KEYS = "row_id, l_linenumber, l_partkey, l_suppkey"
KEY_COLS = ["row_id", "l_linenumber", "l_partkey", "l_suppkey"]


def four(c, names: str):
    return [(F.get(c, F.lit(i)) + 0.0).alias(n) for i, n in enumerate(names.split())]


@query(f"{NORM} select {KEYS}, ny1, nx1, ny2, nx2 from n")
def box_to_norm1000(spark: SparkSession, sf: str) -> DataFrame:
    n = geom.pixel_to_norm1000(F.col("box"), F.col("width"), F.col("height"))
    return pixel_boxes(spark, sf).withColumn("n", n).select(*KEY_COLS, *four(F.col("n"), "ny1 nx1 ny2 nx2"))


@query(f"{NORM} select {KEYS}, round(nx1 / 1000 * width, 6) as px1, round(ny1 / 1000 * height, 6) as py1, round(nx2 / 1000 * width, 6) as px2, round(ny2 / 1000 * height, 6) as py2 from n")
def box_to_pixel(spark: SparkSession, sf: str) -> DataFrame:
    n = geom.pixel_to_norm1000(F.col("box"), F.col("width"), F.col("height"))
    p = geom.norm1000_to_pixel(F.col("n"), F.col("width"), F.col("height"))
    x = pixel_boxes(spark, sf).withColumn("n", n).withColumn("p", p)
    return x.select(*KEY_COLS, *(six(F.get("p", F.lit(i))).alias(k) for i, k in enumerate(("px1", "py1", "px2", "py2"))))


@query(f"with {BOXES_SQL} select {KEYS}, y1 as r1, x1 as r2, y2 as r3, x2 as r4 from b")
def box_reorder(spark: SparkSession, sf: str) -> DataFrame:
    return pixel_boxes(spark, sf).withColumn("r", geom.reorder(F.col("box"))).select(*KEY_COLS, *four(F.col("r"), "r1 r2 r3 r4"))


@query(f"""with {BOXES_SQL}, u as (select *, greatest(least(x1 / 4096, 1), 0) as l, greatest(least(y1 / 4096, 1), 0) as t, greatest(least((x1 + (x2 - x1)) / 4096, 1), 0) as r, greatest(least((y1 + (y2 - y1)) / 4096, 1), 0) as d from b)
select {KEYS}, round(t * 1000 + 1e-12, 2) as ny1, round(l * 1000 + 1e-12, 2) as nx1, round(d * 1000 + 1e-12, 2) as ny2, round(r * 1000 + 1e-12, 2) as nx2 from u""")
def ltwh_to_norm1000(spark: SparkSession, sf: str) -> DataFrame:
    s = [F.col(c) / 4096.0 for c in ("x1", "y1", "bw", "bh")]
    return pixel_boxes(spark, sf).withColumn("n", geom.ltwh_to_norm1000(*s)).select(*KEY_COLS, *four(F.col("n"), "ny1 nx1 ny2 nx2"))


@query(f"with {BOXES_SQL} select {KEYS}, x1, y1, x2 + 1 as x2, y2 + 2 as y2 from b")
def poly_to_box(spark: SparkSession, sf: str) -> DataFrame:
    x, y, r, d = F.col("x1"), F.col("y1"), F.col("x1") + F.col("bw"), F.col("y1") + F.col("bh")
    p = geom.poly_to_box(F.array(x, y + 1, r, y, r + 1, d, x + 1, d + 2))
    return pixel_boxes(spark, sf).withColumn("p", p).select(*KEY_COLS, *four(F.col("p"), "x1 y1 x2 y2"))


@query(f"""with {BOXES_SQL}, r as (select distinct row_id, width, height from b)
select row_id, round(greatest(width / height, height / width), 6) as aspect_ratio, case when greatest(width / height, height / width) > 4 then 'bad' else 'ok' end as route from r""")
def aspect_filter(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.aspect_ratio(vqa_pixel(spark, sf))
    return x.select("row_id", F.round("aspect_ratio", 6).alias("aspect_ratio"), F.col("_route").alias("route"))


RATIOS = f"""with {BOXES_SQL}, c as (select row_id, k, (greatest(least(x2, width), 0) - greatest(least(x1, width), 0)) * (greatest(least(y2, height), 0) - greatest(least(y1, height), 0)) / (width::double * height) as ratio from b)"""


@query(f"{RATIOS} select row_id, count(*) filter (ratio <= 0.2)::bigint as n_kept, coalesce(string_agg((k - 1)::varchar, ',' order by k) filter (ratio > 0.2), '') as dropped, case when count(*) filter (ratio <= 0.2) = 0 then 'bad' else 'ok' end as route from c group by row_id")
def area_ratio_filter(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.area_ratio(vqa_pixel(spark, sf))
    return x.select("row_id", F.size("kept_boxes").cast("long").alias("n_kept"), F.array_join(F.col("dropped_bbox_indices").cast("array<string>"), ",").alias("dropped"), F.col("_route").alias("route"))


@query(f"{RATIOS} select row_id, count(*)::bigint as n_boxes, round(min(ratio), 6) as least_ratio from c group by row_id having count(*) filter (ratio <= 0.1) = 0")
def area_ratio_dropped(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.area_ratio(vqa_pixel(spark, sf), threshold=0.1).where("_route = 'bad'")
    least = F.array_min(F.transform("bboxs", lambda b: geom.area_ratio(b, F.col("width"), F.col("height"))))
    return x.select("row_id", F.size("bboxs").cast("long").alias("n_boxes"), F.round(least, 6).alias("least_ratio"))


def _hist_sql(values: str) -> str:
    return f"""{RATIOS}, v as ({values}), e as (select i, case when i = 21 then 1.0 else i * 0.05::double end as lo, case when i = 20 then 1.0 else (i + 1) * 0.05::double end as hi from (select unnest(range(21)) as i))
select e.i::int as bin, round(lo, 6) as bin_left, round(hi, 6) as bin_right, count(ratio)::bigint as n from e left join v on ratio >= lo and (ratio < hi or (e.i = 20 and ratio <= hi)) group by 1, 2, 3"""


def _hist(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    h = stats.ratio_histogram(stats.ratios(vqa_pixel(spark, sf), mode))
    return h.select("bin", F.round("bin_left", 6).alias("bin_left"), F.round("bin_right", 6).alias("bin_right"), "n")


@query(_hist_sql("select least(greatest(ratio, 0), 1) as ratio from c where ratio > 0"))
def area_hist_per_box(spark: SparkSession, sf: str) -> DataFrame:
    return _hist(spark, sf, "per_bbox")


@query(_hist_sql("select least(sum(ratio), 1) as ratio from c where ratio > 0 group by row_id"))
def area_hist_row_sum(spark: SparkSession, sf: str) -> DataFrame:
    return _hist(spark, sf, "per_row_sum")


@query(_hist_sql("select least(max(ratio), 1) as ratio from c where ratio > 0 group by row_id"))
def area_hist_row_max(spark: SparkSession, sf: str) -> DataFrame:
    return _hist(spark, sf, "per_row_max")


@query(f"{RATIOS}, v as (select least(ratio, 1) as ratio from c where ratio > 0) select p::int as percent, round(quantile_cont(ratio, p / 100.0), 6) as value from v, (values (0), (25), (50), (75), (90), (95), (99), (100)) t(p) group by p".replace("quantile_cont(ratio, p / 100.0)", "case p when 0 then quantile_cont(ratio, 0) when 25 then quantile_cont(ratio, 0.25) when 50 then quantile_cont(ratio, 0.5) when 75 then quantile_cont(ratio, 0.75) when 90 then quantile_cont(ratio, 0.9) when 95 then quantile_cont(ratio, 0.95) when 99 then quantile_cont(ratio, 0.99) else quantile_cont(ratio, 1) end"))
def area_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return stats.ratio_percentiles(stats.ratios(vqa_pixel(spark, sf)))


COUNTS = f"with {BOXES_SQL}, c as (select row_id, count(*) as n from b group by 1)"


@query(f"""{COUNTS} select count(*)::bigint as n_rows, min(n)::bigint as least, max(n)::bigint as most, round(avg(n), 6) as mean, round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.5), 6) as median, round(quantile_cont(n, 0.75), 6) as p75, round(quantile_cont(n, 0.9), 6) as p90, round(quantile_cont(n, 0.95), 6) as p95, round(quantile_cont(n, 0.99), 6) as p99, count(*) filter (n = 0)::bigint as num_zero, round(count(*) filter (n = 0) * 100.0 / count(*), 6) as pct_zero from c""")
def box_count_summary(spark: SparkSession, sf: str) -> DataFrame:
    return stats.count_summary(stats.box_count(vqa_pixel(spark, sf)))


@query(f"{COUNTS} select k::bigint as k, count(n)::bigint as n from (select unnest(range(12)) as k) left join c on least(n, 11) = k group by 1")
def box_count_hist(spark: SparkSession, sf: str) -> DataFrame:
    return stats.count_histogram(stats.box_count(vqa_pixel(spark, sf)), max_k=10)


def mixed_items(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each line item with a JSON box whose kind goes by l_partkey % 7, and a row text of all."""
    n = [F.format_number(F.floor(c), 0) for c in (F.col("l_quantity"), F.col("l_quantity") + 1, F.col("l_quantity") + 2, F.col("l_quantity") + 3)]
    k = F.col("l_partkey") % 7
    box = (
        F.when(k == 0, F.concat(F.lit("["), F.concat_ws(",", *n[:3]), F.lit("]")))
        .when(k == 1, F.concat(F.lit('{"ymin":'), n[0], F.lit(',"xmin":'), n[1], F.lit(',"ymax":'), n[2], F.lit(',"xmax":'), n[3], F.lit("}")))
        .when(k == 2, F.concat(F.lit('["x",'), F.concat_ws(",", *n[1:]), F.lit("]")))
        .when(k == 4, F.concat(F.lit('["'), n[0], F.lit('",'), F.concat_ws(",", *n[1:]), F.lit("]")))
        .otherwise(F.concat(F.lit("["), F.concat_ws(",", *n), F.lit("]")))
    )
    status = F.when(F.col("l_linestatus") == "O", "Failed").otherwise("ok")
    item = F.when(k == 3, box).otherwise(F.concat(F.lit('{"role":"answer","label":"'), F.col("l_returnflag"), F.lit('","is_semantic":false,"ocr_status":"'), status, F.lit('","bbox":'), box, F.lit("}")))
    x = table(spark, sf, "lineitem").withColumn("item", item)
    rows = x.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "item"))).alias("i"))
    return rows.select(F.col("l_orderkey").alias("row_id"), F.concat(F.lit("["), F.array_join(F.transform("i", lambda v: v["item"]), ","), F.lit("]")).alias("bboxes"))


@query("""with k as (select l_orderkey as row_id, case l_partkey % 7 when 0 then 'bbox_list_len!=4' when 2 then 'bbox_list_non_numeric' when 3 then 'bbox_item_not_dict' end as r from lineitem)
select row_id, coalesce(string_agg(r, ',' order by r), '') as reasons, case when count(r) = 0 then 'ok' else 'bad' end as route from k group by 1""")
def box_validity_reasons(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.box_validity(mixed_items(spark, sf))
    return x.select("row_id", F.array_join(F.array_sort("_reasons"), ",").alias("reasons"), F.col("_route").alias("route"))


@query("""select l_orderkey as row_id, l_orderkey % 2 = 0 and bool_and(l_partkey % 7 in (5, 6)) as success from lineitem group by 1""")
def annotation_success(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("row_id") % 2 == 0, "extractive").otherwise("other")
    return mixed_items(spark, sf).select("row_id", filters.annotation_success(kind, F.col("bboxes")).alias("success"))


@query("select l_orderkey as row_id, bool_or(l_linestatus = 'O' and l_partkey % 7 <> 3) as failed from lineitem group by 1")
def ocr_status_split(spark: SparkSession, sf: str) -> DataFrame:
    return mixed_items(spark, sf).select("row_id", filters.ocr_failed(F.col("bboxes")).alias("failed"))


@query("""select l_orderkey as row_id, count(*) filter (l_partkey % 7 not in (0, 2))::bigint as n_boxes, sum(case when l_partkey % 7 not in (0, 2) then floor(l_quantity) + 1 else 0 end)::double as sum_x from lineitem group by 1""")
def fix_box_format(spark: SparkSession, sf: str) -> DataFrame:
    x = filters.fix_box_format(mixed_items(spark, sf))
    return x.select("row_id", F.size("boxes_yxyx").cast("long").alias("n_boxes"), F.aggregate("boxes_xyxy", F.lit(0.0), lambda s, b: s + F.get(b, F.lit(0))).alias("sum_x"))


@query("select d.doc_id, d.source, case when l.doc_id is null then 'missing' else 'failed' end as why from documents d left join (select doc_id, max(toxic) as t from labels group by 1) l on d.doc_id = l.doc_id where l.doc_id is null or l.t = 1")
def todo_missing_or_failed(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "labels").select("doc_id", (F.col("toxic") == 1).alias("failed"))
    return joins.todo_rows(table(spark, sf, "documents"), done, ["doc_id"]).select("doc_id", "source", F.col("_why").alias("why"))


def _assets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = table(spark, sf, "customer")
    image = F.concat(F.lit("img/"), F.col("o_custkey").cast("string"), F.lit(".png"))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", image.alias("image"))
    images = c.where("c_acctbal > 0").select(F.concat(F.lit("img/"), F.col("c_custkey").cast("string"), F.lit(".png")))
    return rows, images, c.where("c_nationkey <> 3").select(F.col("c_custkey").cast("string"))


@query("select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0) and o_custkey in (select c_custkey from customer where c_nationkey <> 3)")
def valid_assets(spark: SparkSession, sf: str) -> DataFrame:
    return joins.valid_assets(*_assets(spark, sf)).select("o_orderkey")


@query("select distinct 'img/' || o_custkey || '.png' as name from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def missing_assets(spark: SparkSession, sf: str) -> DataFrame:
    rows, images, _ = _assets(spark, sf)
    return joins.missing_assets(rows, images, "image")


@query(f"with {FILES_SQL}, t as (select distinct name from g where page_id % 4 = 0) select page_id, name as norm_name from (select *, row_number() over (partition by name order by page_id) as n from g where name in (select name from t)) where n = 1")
def rows_by_target(spark: SparkSession, sf: str) -> DataFrame:
    f = url_files(spark, sf)
    return joins.rows_by_target(f, f.where("page_id % 4 = 0").select("path"), "path", ["page_id"]).select("page_id", "norm_name")


@query(f"with {FILES_SQL} select name as norm_name, string_agg(distinct path, '|' order by path) as originals from g where page_id % 4 = 0 and name not in (select name from g where page_id % 3 = 1) group by 1")
def targets_missing(spark: SparkSession, sf: str) -> DataFrame:
    f = url_files(spark, sf)
    x = joins.missing_targets(f.where("page_id % 3 = 1"), f.where("page_id % 4 = 0").select("path"), "path")
    return x.select("norm_name", F.array_join("originals", "|").alias("originals"))


@query(f"""with {FILES_SQL}, l as (select name, min(path) as src from g where page_id % 3 <> 2 group by 1), t as (select page_id as ord, path as target, name, row_number() over (partition by name order by page_id) as n from g where page_id % 4 = 0)
select ord, target, src, case when src is null then 'missing' when n > 1 then 'skip' else 'copy' end as action from t left join l using (name)""")
def copy_plan(spark: SparkSession, sf: str) -> DataFrame:
    f = url_files(spark, sf)
    return joins.copy_plan(f.where("page_id % 4 = 0").select(F.col("page_id").alias("ord"), F.col("path").alias("target")), f.where("page_id % 3 <> 2").select("path"))


@query("""select o_orderkey, case o_custkey % 4 when 0 then o_custkey || '.png' when 1 then o_custkey || '.jpg' when 2 then o_custkey || '.webp' end as found from orders""")
def image_lookup_fallback(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.lit(".png")).alias("image"), "o_custkey")
    k = F.col("o_custkey") % 4
    ext = F.when(k == 0, ".png").when(k == 1, ".jpg").when(k == 2, ".webp")
    there = o.select(F.concat(F.col("o_custkey").cast("string"), ext)).where(k != 3).unionAll(o.select(F.concat(F.col("o_custkey").cast("string"), F.lit(".webp"))).where(k == 1))
    return joins.image_lookup(o, there, "image", [".jpg", ".webp"]).select("o_orderkey", "found")


@query(f"with {WORDS_SQL} select doc_id, count(*)::bigint as n_words, sum(word_idx)::bigint as sum_idx, max(line_idx)::bigint as last_line from w group by 1")
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_words(spark, sf).groupBy("doc_id").agg(F.count("*").alias("n_words"), F.sum("word_idx").alias("sum_idx"), F.max("line_idx").cast("long").alias("last_line"))


@query(f"with {WORDS_SQL} select regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') as skeleton, count(*)::bigint as n from w group by 1")
def skeletons(spark: SparkSession, sf: str) -> DataFrame:
    return word_forms(spark, sf).groupBy("skeleton").agg(F.sum("n").alias("n"))


def word_forms(spark: SparkSession, sf: str) -> DataFrame:
    """(text, n, norm, skeleton) of the distinct words: NFKC runs once a word and not once an occurrence."""
    w = ocr_words(spark, sf).groupBy("text").agg(F.count("*").alias("n"))
    w = w.withColumn("norm", tx.norm_basic(F.col("text")))
    return w.withColumn("skeleton", tx.alnum_skeleton(F.col("norm")))


@query("""with s as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, printf('%d,%03d.%d.%d', l_partkey % 50, l_suppkey % 1000, l_linenumber, l_partkey % 10) as t from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, t, split_part(replace(t, ',', '.'), '.', 1) || '.' || replace(substr(replace(t, ',', '.'), strpos(replace(t, ',', '.'), '.') + 1), '.', '') as num from s""")
def numeric_skeletons(spark: SparkSession, sf: str) -> DataFrame:
    t = F.format_string("%d,%03d.%d.%d", F.col("l_partkey") % 50, F.col("l_suppkey") % 1000, F.col("l_linenumber"), F.col("l_partkey") % 10)
    return table(spark, sf, "lineitem").withColumn("t", t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "t", tx.numeric_skeleton(F.col("t")).alias("num"))


@query(f"with {WORDS_SQL} select doc_id, count(*) filter (regexp_matches(text, '[0-9]'))::bigint as n_numeric from w group by 1")
def numericish(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_words(spark, sf).groupBy("doc_id").agg(F.count_if(tx.numericish(F.col("text"))).alias("n_numeric"))


STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)
LABELS = f"""lb as (select item_id, regexp_split_to_array(lower(trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g'))), ' ') as ts from benchmark),
tk as (select item_id, unnest(ts) as t, unnest(range(len(ts))) as i from lb),
fk as (select item_id, t, i from tk where t not in ({STOP}) and regexp_replace(t, '[^a-z0-9]+', '', 'g') <> ''),
an as (select item_id, t, regexp_replace(t, '[^a-z0-9]+', '', 'g') as skel, row_number() over (partition by item_id order by (case when regexp_matches(t, '[0-9]') then 10 else 0 end + least(length(regexp_replace(t, '[^a-z0-9]+', '', 'g')), 12) / 12.0::double * 2) desc, dense) as rank from (select *, row_number() over (partition by item_id order by i) as dense from fk))"""


def label_anchors(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "benchmark").withColumn("norm", tx.norm_basic(F.col("text")))
    return b.select("item_id", F.posexplode(tx.anchors(tx.tokens(F.col("norm")))).alias("i", "t")).select("item_id", (F.col("i") + 1).cast("long").alias("rank"), "t")


@query(f"with {LABELS} select item_id, rank::bigint as rank, t from an where rank <= 5")
def anchor_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return label_anchors(spark, sf)


@query(f"with {LABELS}, {WORDS_SQL} select item_id, doc_id, count(distinct word_idx)::bigint as n_hits from an join w on skel = regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') where rank <= 5 group by 1, 2")
def anchor_hits(spark: SparkSession, sf: str) -> DataFrame:
    a = label_anchors(spark, sf).select("item_id", tx.alnum_skeleton(F.col("t")).alias("skeleton")).distinct()
    forms = word_forms(spark, sf).join(a, "skeleton").select("item_id", "text")
    return ocr_words(spark, sf).join(forms, "text").groupBy("item_id", "doc_id").agg(F.countDistinct("word_idx").alias("n_hits"))


@query(f"with {WORDS_SQL}, l as (select doc_id, line_idx, min(word_idx) as a, max(word_idx) as b from w group by 1, 2) select doc_id, line_idx, min(a) over (partition by doc_id order by line_idx range between 2 preceding and 2 following) as lo, max(b) over (partition by doc_id order by line_idx range between 2 preceding and 2 following) as hi from l")
def line_windows(spark: SparkSession, sf: str) -> DataFrame:
    return joins.line_windows(ocr_words(spark, sf))


@query("""with p as (select o_custkey, list(o_orderkey order by o_orderkey) as h from orders group by 1) select o_custkey, string_agg(h[1 + i * greatest(1, len(h) // 3)]::varchar, ',' order by i) as sampled from p, range(3) t(i) where i * greatest(1, len(h) // 3) < len(h) group by 1""")
def anchor_sampling(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("h"))
    step = F.greatest(F.lit(1), F.expr("cast(size(h) div 3 as int)"))
    picked = F.slice(F.filter("h", lambda x, i: i % step == 0), 1, 3)
    return h.select("o_custkey", F.array_join(picked.cast("array<string>"), ",").alias("sampled"))


@query(f"""with {WORDS_SQL}, m as (select doc_id, line_idx, count(*) as n from w where lower(text) in ('the', 'and', 'de', 'der', 'le') group by 1, 2),
g as (select *, case when line_idx - lag(line_idx) over (partition by doc_id order by line_idx) <= 1 then 0 else 1 end as s from m),
c as (select *, sum(s) over (partition by doc_id order by line_idx) as k from g) select doc_id, min(line_idx) as first_line, max(line_idx) as last_line, sum(n)::bigint as n_words from c group by doc_id, k""")
def line_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return joins.line_clusters(ocr_words(spark, sf).where(F.lower("text").isin("the", "and", "de", "der", "le")))


@query("""with g as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, 1 + l_partkey % 14 as n, (l_partkey % 21) / 20.0::double as cov, (l_suppkey % 21) / 20.0::double as cr, (l_partkey % 13) / 100.0::double as iou, (l_suppkey % 31) / 100.0::double as dist, l_linenumber % 2 = 0 as pr from lineitem),
t as (select *, case when n <= 4 then 0.75 when n <= 10 then 0.65 else 0.55 end::double as a, case when n <= 4 then 0.55 when n <= 10 then 0.5 else 0.45 end::double as b from g),
e as (select *, case when pr and dist <= 0.06 then greatest(0.3, a - 0.15) else a end::double as c1, case when pr and dist <= 0.06 then greatest(0.3, b - 0.1) else b end::double as c2 from t)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, case when cov >= c1 or cr >= c2 then 'ok' when (not pr or dist <= 0.12 or iou >= 0.02) and (cov >= greatest(0.25, c1 - 0.2) or cr >= greatest(0.25, c2 - 0.15) or (0.7::double * cov + 0.3::double * cr >= 0.42 and greatest(cov, cr) >= 0.35)) then 'ok_relaxed' else 'below_threshold' end as reason from e""")
def match_gate(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    reason = align.gate_columns(1 + c("l_partkey") % 14, (c("l_partkey") % 21) / 20.0, (c("l_suppkey") % 21) / 20.0, (c("l_partkey") % 13) / 100.0, (c("l_suppkey") % 31) / 100.0, c("l_linenumber") % 2 == 0)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", reason.alias("reason"))


def _ocr_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each document with an image name and boxes: six words from its middle (one of them changed for some) as answer, a benchmark item
    as context, a blank label and a semantic box. Some rows have no image, no boxes, or an image without words."""
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("item"), (F.row_number().over(Window.orderBy("item_id")) - 1).alias("k"))
    n = table(spark, sf, "benchmark").select(F.count("*").alias("n_items"))
    d = table(spark, sf, "documents").withColumn("ws", F.filter(F.split("text", "[ \\n\\t]+"), lambda w: w != ""))
    d = d.crossJoin(F.broadcast(n)).withColumn("k", F.col("doc_id") % F.col("n_items")).join(F.broadcast(items), "k")  # the items table is a query set of its own, one row meets each document
    mid = F.floor(F.size("ws") / 2).cast("int")
    own = F.array_join(F.transform(F.slice("ws", F.greatest(mid, F.lit(1)), F.lit(6)), lambda w, i: F.when((F.col("doc_id") % 3 == 0) & (i == 1), F.lit("changed")).otherwise(w)), " ")
    y = (F.floor(mid / 8) % 100) * 10.0
    box = lambda role, label, sem, *b: F.struct(F.lit(role).alias("role"), label.alias("label"), F.array(*(F.lit(v).cast("double") if not hasattr(v, "cast") else v.cast("double") for v in b)).alias("bbox"), F.lit(sem).alias("is_semantic"))
    boxes = F.array(box("answer", own, False, y, 0.0, y + 10.0, 990.0), box("context", F.col("item"), False, 0.0, 0.0, 80.0, 900.0), box("context", F.lit(" "), False, 1, 2, 3, 4), box("answer", F.lit("x"), True, 5, 6, 7, 8))
    name = F.when(F.col("doc_id") % 50 == 7, F.lit(None)).when(F.col("doc_id") % 50 == 8, F.concat(F.lit("img/none"), F.col("doc_id"), F.lit(".png"))).otherwise(F.concat(F.lit("img/"), F.col("doc_id"), F.lit(".png")))
    asked = F.when(F.col("doc_id") % 5 == 0, "How many?").otherwise("Which?")
    return d.select(F.col("doc_id").alias("row_id"), name.alias("image"), asked.alias("question"), (F.col("doc_id") % 3).cast("string").alias("answer"), F.array(own).alias("possible_answers"), F.when(F.col("doc_id") % 50 != 9, boxes).alias("bboxes"), (600.0 + F.col("doc_id") % 7 * 200).alias("width"), (400.0 + F.col("doc_id") % 11 * 300).alias("height"))


def _doc_words(spark: SparkSession, sf: str) -> DataFrame:
    return ocr_words(spark, sf).withColumn("doc_id", F.col("doc_id").cast("string"))


@query()
def verify_boxes_infovqa(spark: SparkSession, sf: str) -> DataFrame:
    _, report = policies.verify_infovqa(_ocr_rows(spark, sf), _doc_words(spark, sf))
    return report.select("row_id", "bbox_idx", "role", "ok", "reason", "score", "coverage", "char_ratio", "iou", "dist", "action")


@query()
def verify_rows_infovqa(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = policies.verify_infovqa(_ocr_rows(spark, sf), _doc_words(spark, sf))
    return policies.sinks(rows, policies.INFOVQA_SINKS).select("row_id", "_route", "_reason", "_sink", F.size("new_boxes").alias("n_boxes"))


@query()
def correct_boxes_docvqa(spark: SparkSession, sf: str) -> DataFrame:
    x = _ocr_rows(spark, sf).withColumn("boxes", F.transform("bboxes", lambda b: F.struct(F.nullif(F.trim(b["label"]), F.lit("")).alias("label"), b["bbox"].alias("bbox"))))
    rows, _ = policies.correct_docvqa(x, _doc_words(spark, sf), input_format="norm1000")
    return policies.sinks(rows, policies.DOCVQA_SINKS).select("row_id", "_route", "_reason", "_sink", F.count_if(F.lit(True)).over(Window.partitionBy("row_id")).alias("n_sinks"))


TURNS_SQL = """
u as (select conv_id, turn, list_filter(list_transform(regexp_split_to_array(lower(text), '\\s+'), lambda t: regexp_replace(t, '[^a-z0-9]+', '', 'g')), lambda t: t <> '') as ts from conversations where text is not null)"""


@query(f"""with recursive {TURNS_SQL}, p as (select a.conv_id, a.turn, a.ts as label, b.ts as toks from u a join u b on a.conv_id = b.conv_id and b.turn = a.turn + 1),
r(conv_id, turn, j, i) as (select conv_id, turn, 0, 0 from p union all select r.conv_id, r.turn, j + 1, case when i < len(label) and label[i + 1] = toks[j + 1] then i + 1 else i end from r join p on r.conv_id = p.conv_id and r.turn = p.turn where j < len(toks)),
z as (select conv_id, turn, max(i) as i from r group by 1, 2)
select p.conv_id, p.turn, z.i::bigint as met, round(case when len(label) > 0 then z.i / len(label)::double else 0 end, 6) as coverage from p join z on p.conv_id = z.conv_id and p.turn = z.turn""")
def subseq_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn of a conversation as label against the turn after it."""
    c = table(spark, sf, "conversations").where("text is not null")
    ts = F.filter(F.transform(F.split(F.lower("text"), r"\s+"), tx.alnum_skeleton), lambda t: t != "")
    u = c.select("conv_id", "turn", ts.alias("ts"))
    p = u.select("conv_id", "turn", F.col("ts").alias("label")).join(u.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("ts").alias("toks")), ["conv_id", "turn"])
    met = align.subsequence_count(F.col("label"), F.col("toks"))
    return p.select("conv_id", "turn", met.cast("long").alias("met"), F.round(align.subsequence_coverage(F.col("label"), F.col("toks")), 6).alias("coverage"))


@query()
def char_ratio(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.round(tx.sequence_ratio(tx.alnum_skeleton(F.lower("p_name")), tx.alnum_skeleton(F.lower("p_type"))), 6).alias("ratio"))


@query("""select o_orderkey, (case o_orderkey % 4 when 0 then o_custkey % 100 when 1 then o_orderkey % 20 + 1 when 2 then 3 end)::int as number, o_orderkey % 2 = 0 as how_many from orders""")
def how_many_answers(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array(*(F.lit(w) for w in list(tx.NUMBER_WORDS)[1:21]))
    k = F.col("o_orderkey") % 4
    answer = F.when(k == 0, F.concat(F.lit("about "), (F.col("o_custkey") % 100).cast("string"))).when(k == 1, F.element_at(words, (F.col("o_orderkey") % 20 + 1).cast("int"))).when(k == 2, F.lit("Three items")).otherwise(F.lit("none of them"))
    asked = F.when(F.col("o_orderkey") % 2 == 0, "  How many units?").otherwise("Which unit?")
    return table(spark, sf, "orders").select("o_orderkey", tx.first_number(F.array(answer)).cast("int").alias("number"), tx.asks_how_many(asked).alias("how_many"))


@query("""select conv_id, count(*)::bigint as num_clips, string_agg(turn || ':' || (2 * turn) || '-' || (2 * turn + 2) || ':' || role, '|' order by turn) as clips from conversations group by 1""")
def clips_structured(spark: SparkSession, sf: str) -> DataFrame:
    caption = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("  Main  caption : "), F.col("role"))).otherwise(F.col("role"))
    c = F.struct(F.col("turn").alias("clip_id"), (F.col("turn") * 2).alias("start_time"), (F.col("turn") * 2 + 2).alias("end_time"), caption.alias("main_caption"))
    x = records.structure_clips(table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(c).alias("clips")))
    one = F.transform("clips", lambda v: F.concat(v["clip_id"].cast("string"), F.lit(":"), F.array_join(v["span"].cast("array<string>"), "-"), F.lit(":"), v["caption"]))
    return x.select("conv_id", F.col("num_clips").cast("long").alias("num_clips"), F.array_join(one, "|").alias("clips"))


@query("""select event_id, case when event_id % 5 = 0 then 'deck_unknown_from_' || event_id else 'deck' || user_id end as deck_id, case when event_id % 3 = 0 then user_id || ',' || (user_id + 2) end as evidence_pages, (user_id % 4)::bigint as n_pages from events""")
def slide_rows(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.col("event_id").alias("qid"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("pages "), F.col("user_id").cast("string"), F.lit(" and "), (F.col("user_id") + 2).cast("string"))).otherwise("none").alias("evidence"), (F.col("user_id") % 4).alias("num_pages"), F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.concat(F.lit("deck"), F.col("user_id").cast("string"))).alias("deck_id"))
    return records.slide_rows(e).select(F.col("qid").alias("event_id"), "deck_id", F.array_join(F.col("evidence_pages").cast("array<string>"), ",").alias("evidence_pages"), F.size("pages").cast("long").alias("n_pages"))


@query("select event_id, props->>'k' as pages from events where props->>'k' is not null")
def evidence_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.array_join(tx.page_numbers(F.col("props")).cast("array<string>"), ",").alias("pages")).where("pages is not null")


@query("""select o_orderkey, 'img/' || o_custkey || '.png' as path, (o_custkey % 50)::double as x1, 'Which priority?' as question, o_orderpriority as answer, 0.25::double as nx1 from orders""")
def cot_parse(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("o_custkey")
    path = F.concat(F.lit("img/"), c.cast("string"), F.lit(".png"))
    box = F.concat(path, F.lit("###["), (c % 50).cast("string"), F.lit(", 1, 90, 95]"))
    turn = lambda who, v: F.struct(F.lit(who).alias("from"), v.alias("value"))
    turns = F.array(turn("human", F.lit("<image> Which priority?  Please provide the box.")), turn("gpt", F.lit("[0.25, 0.1, 0.5, 0.75]")), turn("human", F.lit("<image>")), turn("gpt", F.col("o_orderpriority")))
    x = records.cot_rows(table(spark, sf, "orders").select("o_orderkey", F.array(path, box).alias("image"), turns.alias("conversations")))
    return x.select("o_orderkey", "path", F.get(F.get("boxes", F.lit(0)), F.lit(0)).alias("x1"), "question", "answer", F.get("norm_box", F.lit(0)).alias("nx1"))


@query("""select o_orderkey, (case when o_orderkey % 4 = 3 then null else o_custkey end)::bigint as v from orders""")
def llm_json_extract(spark: SparkSession, sf: str) -> DataFrame:
    body = F.concat(F.lit('{"v": '), F.col("o_custkey").cast("string"), F.lit("}"))
    k = F.col("o_orderkey") % 4
    reply = F.when(k == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 1, F.concat(F.lit("Here it is: "), body, F.lit(" as asked."))).when(k == 2, body).otherwise(F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit("]")))
    return table(spark, sf, "orders").select("o_orderkey", F.try_variant_get(F.try_parse_json(tx.json_object_in(reply)), "$.v", "long").alias("v"))


@query(f"with {BOXES_SQL} select row_id, count(*)::bigint as n_boxes, 'extractive' as answer_type, 'ok' as route from b group by 1")
def annotate_stub_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = vqa_pixel(spark, sf).select("row_id", records.seed_boxes(F.col("bboxs")).alias("seed_boxes"))
    asked = rows.withColumn("prompt", records.prompt(F.lit("Which box?"), F.col("seed_boxes")))
    x = records.merge_replies(rows, records.annotate(asked, "row_id", "prompt"), "row_id")
    return x.select("row_id", F.size("bboxes").cast("long").alias("n_boxes"), "answer_type", F.col("_route").alias("route"))


@query(f"""{NORM} select printf('%06d__%d.png', row_id, image) as out_name, (k - 1)::int as box_no, rint_even(greatest(least(nx1 / 1000 * width, width - 1), 0))::int as x1, case l_returnflag when 'R' then 'green' else 'red' end as color from n""".replace("rint_even(", "round_even(").replace("width - 1), 0))", "width - 1), 0), 0)"))
def draw_plan(spark: SparkSession, sf: str) -> DataFrame:
    role = lambda v: F.when(v["l_returnflag"] == "R", "answer").otherwise("context")
    x = vqa_pixel(spark, sf)
    x = x.withColumn("bboxes", F.transform("items", lambda v: F.struct(role(v).alias("role"), F.lit("").alias("label"), geom.pixel_to_norm1000(v["box"], F.col("width"), F.col("height")).alias("bbox"))))
    x = x.withColumn("name", F.concat(F.lit("img/"), F.col("image").cast("string"), F.lit(".jpg")))
    return records.draw_plan(x, "row_id", "name").select("out_name", "box_no", "x1", "color")


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    """An OCR document of LINE and WORD blocks for each order: a word for each line item, lines of three by place."""
    b = vqa_pixel(spark, sf)
    word = lambda v, i: F.struct(F.concat(F.lit("w"), i.cast("string")).alias("Id"), v["l_returnflag"].alias("Text"), (v["l_quantity"]).alias("Confidence"), F.struct(F.struct((F.get(v["box"], F.lit(0)) / 4096).alias("Left"), (F.get(v["box"], F.lit(1)) / 4096).alias("Top"), F.lit(0.125).alias("Width"), F.lit(0.0625).alias("Height")).alias("BoundingBox")).alias("Geometry"))
    n = F.size("items")
    line = lambda j: F.struct(F.concat(F.lit("l"), j.cast("string")).alias("Id"), F.concat(F.lit("line "), j.cast("string")).alias("Text"), F.array(F.struct(F.lit("CHILD").alias("Type"), F.transform(F.sequence(j * 3, F.least(j * 3 + 2, n - 1)), lambda k: F.concat(F.lit("w"), k.cast("string"))).alias("Ids"))).alias("Relationships"))
    lines = F.transform(F.sequence(F.lit(0), F.expr("cast((size(items) - 1) div 3 as int)")), line)
    return b.select(F.col("row_id").cast("string").alias("doc_id"), F.to_json(F.struct(lines.alias("LINE"), F.transform("items", word).alias("WORD"))).alias("ocr"))


@query(f"with {BOXES_SQL} select row_id::varchar as doc_id, (k - 1)::int as word_idx, l_returnflag as text, ((k - 1) // 3)::int as line_idx, 'line ' || ((k - 1) // 3) as line_text, round(least(y1 / 4096, 1) * 1000 + 1e-12, 2) as ny1, round(least(x1 / 4096 + 0.125, 1) * 1000 + 1e-12, 2) as nx2 from b")
def ocr_textract_words(spark: SparkSession, sf: str) -> DataFrame:
    w = ocr.block_words(_blocks(spark, sf))
    return w.select("doc_id", "word_idx", "text", "line_idx", "line_text", F.get("bbox", F.lit(0)).alias("ny1"), F.get("bbox", F.lit(3)).alias("nx2"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """A document of one page per order: a line for each line item; every second one without words, else two words."""
    poly = lambda v, dx: F.array(F.get(v["box"], F.lit(0)) + dx, F.get(v["box"], F.lit(1)), F.get(v["box"], F.lit(2)) + dx, F.get(v["box"], F.lit(1)), F.get(v["box"], F.lit(2)) + dx, F.get(v["box"], F.lit(3)), F.get(v["box"], F.lit(0)) + dx, F.get(v["box"], F.lit(3)))
    word = lambda v, dx, t: F.struct(poly(v, dx).alias("boundingBox"), F.lit(t).alias("text"), F.lit("High").alias("confidence"))
    words = lambda v: F.when(v["l_partkey"] % 2 == 0, F.array(word(v, 0.0, "a"), word(v, 8.0, "b"))).otherwise(F.array().cast("array<struct<boundingBox:array<double>,text:string,confidence:string>>"))
    line = lambda v: F.struct(poly(v, 0.0).alias("boundingBox"), v["l_returnflag"].alias("text"), words(v).alias("words"))
    page = F.struct(F.lit(1).alias("page"), F.lit(4096.0).alias("width"), F.lit(2048.0).alias("height"), F.lit("pixel").alias("unit"), F.transform("items", line).alias("lines"))
    return vqa_pixel(spark, sf).select(F.col("row_id").cast("string").alias("doc_id"), F.to_json(F.struct(F.lit("Succeeded").alias("status"), F.array(page).alias("recognitionResults"))).alias("ocr"))


@query(f"""with {BOXES_SQL}, x as (select row_id, k, x1, 0 as j, case when l_partkey % 2 = 0 then 'a' else l_returnflag end as text, l_partkey % 2 <> 0 as bare from b union all select row_id, k, x1 + 8, 1, 'b', false from b where l_partkey % 2 = 0)
select row_id::varchar as doc_id, (row_number() over (partition by row_id order by k, j) - 1)::int as word_idx, (k - 1)::int as line_idx, j::int as word_in_line, text, case when bare then 'LINE_FALLBACK' else 'WORD' end as level, round(least(x1, 4096) * 1000 / 4096 + 1e-12, 2) as nx1 from x""")
def ocr_azure_words(spark: SparkSession, sf: str) -> DataFrame:
    w = ocr.page_words(_pages(spark, sf), skip_non_succeeded=True)
    return w.select("doc_id", F.col("word_idx").cast("int").alias("word_idx"), "line_idx", "word_in_line", "text", F.col("_src_level").alias("level"), F.get("bbox", F.lit(1)).alias("nx1"))
