"""Inputs of the operators, derived from the driver's tables with arithmetic that SQL repeats (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pixel_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each box: row_id, image, width, height, order columns, corners, and the line item's flags."""
    agree = "o_orderkey % 10 < 7"
    return (
        table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey"))
        .selectExpr(
            "o_orderkey as row_id", "o_orderkey div 3 as image", "600 + (o_orderkey % 7) * 200 as width", "400 + (o_custkey % 11) * 300 as height",
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_orderkey", "o_custkey",
            f"cast(case when {agree} then (o_orderkey % 100) * 3 + l_linenumber * 0.5D * (o_orderkey % 2) else l_quantity * 4 end as double) as x1",
            f"cast(case when {agree} then (o_custkey % 200) * 2 else l_partkey % 300 end as double) as y1",
            f"cast(case when {agree} then 60 + (o_orderkey % 9) * 40 else 20 + (l_suppkey % 50) * 6 end as double) as bw",
            f"cast(case when {agree} then 40 + (o_orderkey % 5) * 60 else 10 + l_linenumber * 15 end as double) as bh",
        ).selectExpr("*", "array(x1, y1, x1 + bw, y1 + bh) as box")
    )


def vqa_pixel(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each order with its boxes in order."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    b = pixel_boxes(spark, sf)
    rows = b.groupBy("row_id", "image", "width", "height").agg(F.array_sort(F.collect_list(F.struct(*order, "box", "l_returnflag", "l_linestatus"))).alias("items"))
    return rows.withColumn("bboxs", F.transform("items", lambda x: x["box"]))


#: The same boxes in SQL, as a common table expression `b`.
BOXES_SQL = """
b as (
  select row_id, image, width, height, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, o_custkey,
    x1, y1, x1 + bw as x2, y1 + bh as y2,
    row_number() over (partition by row_id order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as k
  from (select o_orderkey as row_id, o_orderkey // 3 as image, 600 + (o_orderkey % 7) * 200 as width, 400 + (o_custkey % 11) * 300 as height,
    l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, o_custkey,
    (case when o_orderkey % 10 < 7 then (o_orderkey % 100) * 3 + l_linenumber * 0.5 * (o_orderkey % 2) else l_quantity * 4 end)::double as x1,
    (case when o_orderkey % 10 < 7 then (o_custkey % 200) * 2 else l_partkey % 300 end)::double as y1,
    (case when o_orderkey % 10 < 7 then 60 + (o_orderkey % 9) * 40 else 20 + (l_suppkey % 50) * 6 end)::double as bw,
    (case when o_orderkey % 10 < 7 then 40 + (o_orderkey % 5) * 60 else 10 + l_linenumber * 15 end)::double as bh
    from lineitem join orders on l_orderkey = o_orderkey))"""


def ocr_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of documents on a grid of eight columns: (doc_id, word_idx, text, line_idx, bbox)."""
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.filter(F.split("text", "[ \\n\\t]+"), lambda w: w != "")).alias("word_idx", "text"))
    x = d.withColumn("line_idx", F.expr("word_idx div 8").cast("int"))
    y = (F.col("line_idx") % 100) * 10.0
    return x.withColumn("bbox", F.array(y, (F.col("word_idx") % 8) * 125.0, y + 8.0, (F.col("word_idx") % 8) * 125.0 + 120.0))


WORDS_SQL = """
w as (select doc_id, (unnest(range(len(ws))))::int as word_idx, unnest(ws) as text, (unnest(range(len(ws))) // 8)::int as line_idx
  from (select doc_id, list_filter(regexp_split_to_array(text, '[ \\n\\t]+'), lambda x: x <> '') as ws from documents))"""


def url_files(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, path): last part of each page's address without query and fragment; dashes in front for some."""
    name = F.regexp_extract(F.regexp_replace("url", "[?#].*$", ""), "([^/]*)$", 1)
    dashes = F.when(F.col("page_id") % 6 == 0, "----").when(F.col("page_id") % 3 == 0, "--").otherwise("")
    return table(spark, sf, "pages").select("page_id", F.concat(F.lit("clips/"), dashes, name, F.lit(".mp4")).alias("path"))


FILES_SQL = """
f as (select page_id, 'clips/' || case when page_id % 6 = 0 then '----' when page_id % 3 = 0 then '--' else '' end
  || regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) || '.mp4' as path from pages),
g as (select *, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(--)+', '') as name from f)"""
