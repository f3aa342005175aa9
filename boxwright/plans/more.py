"""Further queries: one for each family of functions, over inputs derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from boxwright.functions import geom, text as tx
from boxwright.operators import filters, ocr, records, stats
from boxwright.plans.adapters import BOXES_SQL, FILES_SQL, pixel_boxes, table, url_files, vqa_pixel
from boxwright.plans.catalog import query, six
from boxwright.sources import assets, jsonl

LINE = ["row_id", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_SQL = ", ".join(LINE)


def corner(b, i):
    return F.round(F.get(b, F.lit(i)), 6) + F.lit(0.0)


@query(f"with {BOXES_SQL} select row_id, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2 from b group by 1")
def union_boxes(spark: SparkSession, sf: str) -> DataFrame:
    x = vqa_pixel(spark, sf).withColumn("u", geom.union_box(F.col("bboxs")))
    return x.select("row_id", *(F.get("u", F.lit(i)).alias(k) for i, k in enumerate(("x1", "y1", "x2", "y2"))))


@query(f"""with {BOXES_SQL}, q as (select row_id, k, least(greatest(x1, 0), 1000) as a, least(greatest(y1, 0), 1000) as b, least(greatest(x2, 0), 1000) as c, least(greatest(y2, 0), 1000) as d, width, height, x1, y1, x2, y2 from b)
select p.row_id, p.k::bigint as k, round(sqrt(((p.a + p.c - q.a - q.c) / 2) ** 2 + ((p.b + p.d - q.b - q.d) / 2) ** 2) / 1414.21356237, 6) as dist,
  case when (p.width > 1200 or p.height > 1200) and greatest(p.x1, p.y1, p.x2, p.y2) <= 1000 then 'norm1000' else 'pixel' end as format
from q p join q on p.row_id = q.row_id and q.k = p.k + 1""")
def box_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Each box and the next one of its row: distance of centres, and the format that the first one looks like."""
    x = vqa_pixel(spark, sf).select("row_id", "width", "height", F.posexplode("bboxs").alias("i", "p"), "bboxs")
    x = x.withColumn("q", F.get("bboxs", F.col("i") + 1)).where("q is not null")
    inside = lambda b: F.transform(b, lambda v: geom.clamp(v, 0, 1000))
    return x.select("row_id", (F.col("i") + 1).cast("long").alias("k"), F.round(geom.center_distance(inside(F.col("p")), inside(F.col("q"))), 6).alias("dist"), geom.detected_format(F.col("p"), F.col("width"), F.col("height")).alias("format"))


@query(f"""with {BOXES_SQL}, d as (select *, least(greatest(round_even(x1 * 0.5, 0), 0), round_even(width * 0.5 - 1, 0)) as dx from b)
select {LINE_SQL}, round_even(least(greatest(x1, 0), width - 1), 0) as x1, round_even(least(greatest(y1, 0), height - 1), 0) as y1, round_even(least(greatest(x2, 0), width - 1), 0) as x2, round_even(least(greatest(y2, 0), height - 1), 0) as y2,
  round_even(x1 / 1000 * width, 0) as n1, round_even(y2 / 1000 * height, 0) as n4
from b where round_even(least(greatest(x2, 0), width - 1), 0) > round_even(least(greatest(x1, 0), width - 1), 0) and round_even(least(greatest(y2, 0), height - 1), 0) > round_even(least(greatest(y1, 0), height - 1), 0)""")
def drawn_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Pixel boxes as they are drawn (without degenerate ones), and boxes in 0..1 as pixels."""
    x = pixel_boxes(spark, sf)
    x = x.withColumn("d", geom.draw_pixel_box(F.col("box"), F.col("width"), F.col("height"))).where("d is not null")
    x = x.withColumn("n", geom.norm1_to_pixel(F.transform("box", lambda v: v / 1000), F.col("width"), F.col("height")))
    return x.select(*LINE, *(F.get("d", F.lit(i)).alias(k) for i, k in enumerate(("x1", "y1", "x2", "y2"))), F.get("n", F.lit(0)).alias("n1"), F.get("n", F.lit(3)).alias("n4"))


@query(f"""with {BOXES_SQL}, s as (select row_id, k, (x2 - x1) * (y2 - y1) as s, x1, y1 from b), m as (select row_id, max(s) as s from s group by 1)
select s.row_id, min(s.k)::bigint as k from s join m on s.row_id = m.row_id and s.s = m.s group by 1""")
def largest_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """The largest box of a row, the first of equal ones."""
    x = vqa_pixel(spark, sf).select("row_id", F.posexplode("bboxs").alias("i", "b")).select("row_id", (F.col("i") + 1).cast("long").alias("k"), geom.area(F.col("b")).alias("s"))
    return stats.best_first(x, "row_id", "s", "k").select("row_id", "k")


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, (case l_partkey % 6 when 0 then 2 when 1 then 1 when 2 then 2 when 3 then 0 when 4 then 0 else 1 end)::bigint as n_boxes, l_partkey % 6 in (0, 1, 3, 4) as failed from lineitem""")
def boxes_in_json(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes counted over rows of both shapes, and whether their annotation failed."""
    n = F.floor("l_quantity").cast("int").cast("string")
    box = F.concat(F.lit("["), n, F.lit(", 1, 2, 3]"))
    k = F.col("l_partkey") % 6
    raw = (
        F.when(k == 0, F.concat(F.lit('{"bboxs": ['), box, F.lit(", [1], "), box, F.lit("]}")))
        .when(k == 1, F.concat(F.lit('{"bboxs": ['), box, F.lit('], "bboxes": []}')))
        .when(k == 2, F.concat(F.lit('{"bboxes": [{"bbox": '), box, F.lit('}, {"bbox": 4}, {"bbox": '), box, F.lit("}]}")))
        .when(k == 3, '{"bboxes": []}').when(k == 4, '{"bboxes": "none"}').otherwise(F.concat(F.lit('{"bboxes": ['), box, F.lit(", [1, 2]]}")))
    )
    listed = F.get_json_object(raw, "$.bboxes")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", stats.boxes_per_row(raw).cast("long").alias("n_boxes"), filters.annotation_failed(listed).alias("failed"))


@query("""with t as (select o_orderkey, (o_orderkey % 7)::varchar as a, printf('%d,%d', o_orderkey % 9, o_custkey % 10) as b, 'Item-' || (o_orderkey % 5) as c, 'item ' || (o_custkey % 5) as d from orders)
select o_orderkey, (replace(b, ',', '.') = (o_orderkey % 9) || '.' || (o_orderkey % 10)) or replace(b, ',', '') = (o_orderkey % 9)::varchar || (o_orderkey % 10)::varchar as same_number, o_orderkey % 5 = o_custkey % 5 as same_word, true as same_empty from t join (select o_orderkey as o2, o_custkey from orders) on o_orderkey = o2""")
def equivalent_tokens(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    number = F.format_string("%d,%d", k % 9, F.col("o_custkey") % 10)
    return table(spark, sf, "orders").select(
        "o_orderkey", tx.token_equivalent(number, F.format_string("%d.%d", k % 9, k % 10)).alias("same_number"),
        tx.token_equivalent(F.format_string("item-%d", k % 5), F.format_string("item%d", F.col("o_custkey") % 5)).alias("same_word"), tx.token_equivalent(F.lit("--"), F.lit("?")).alias("same_empty"),
    )


@query("""select o_orderkey, case when o_orderkey % 3 = 0 then 'of the' else 'total' || (o_orderkey % 4) end as content,
  case o_orderkey % 4 when 0 then 'Blue|blue ribbon' when 1 then 'red|Blue' else 'Blue|red' end as labels, case when o_custkey % 2 = 0 then 'deck' || o_custkey when o_orderkey % 2 = 0 then 'deck_unknown_from_' || o_orderkey else 'deck_unknown_' || printf('%08d', o_custkey) end as deck from orders""")
def labels_and_decks(spark: SparkSession, sf: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    toks = F.when(k % 3 == 0, F.array(F.lit("of"), F.lit("the"))).otherwise(F.array(F.lit("the"), F.concat(F.lit("total"), (k % 4).cast("string"))))
    answer = F.when(k % 4 == 1, " red ").otherwise("Blue")
    more = F.when(k % 4 == 0, F.array(F.lit(" blue "), F.lit("BLUE"), F.lit("blue ribbon"), F.lit(" "))).when(k % 4 == 1, F.array(F.lit("RED"), F.lit("Blue"))).otherwise(F.array(F.lit("red"), F.lit("Red")))
    deck = F.when(c % 2 == 0, F.concat(F.lit("deck"), c.cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(tx.content_tokens(toks), " ").alias("content"), F.array_join(tx.label_candidates(tx.label_texts(answer, more)), "|").alias("labels"), tx.deck_id(deck, F.when(k % 2 == 0, k), c).alias("deck"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, case l_partkey % 4 when 0 then l_suppkey::varchar when 1 then l_suppkey::varchar when 2 then (l_suppkey + 0.5)::varchar else '"n/a"' end as number,
  (case l_partkey % 3 when 0 then l_suppkey when 1 then null else 1 end)::bigint as whole, (case when l_partkey % 3 = 0 then l_suppkey end)::bigint as digits, (l_suppkey % 8 + 8 * (l_partkey % 8))::bigint as octal, ((l_suppkey + 511) // 512 * 512)::bigint as blocks,
  case when length('part ' || l_partkey) > 7 then substr('part ' || l_partkey, 1, 6) || '…' else 'part ' || l_partkey end as short from lineitem""")
def casts(spark: SparkSession, sf: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    text = F.when(p % 4 == 0, F.concat(F.lit('" '), s.cast("string"), F.lit(' "'))).when(p % 4 == 1, F.concat(s.cast("string"), F.lit(".0"))).when(p % 4 == 2, F.concat(F.lit('"'), s.cast("string"), F.lit('.5"'))).otherwise('"n/a"')
    whole = F.when(p % 3 == 0, s.cast("string")).when(p % 3 == 1, "x").otherwise("true")
    field = F.concat((p % 8).cast("string"), (s % 8).cast("string"), F.lit("\0 "))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.to_json(tx.number_if_possible(F.try_parse_json(text))).alias("number"), tx.whole_number(whole).alias("whole"), tx.digits_only(whole).alias("digits"),
        tx.octal(field).alias("octal"), tx.round_up_512(s).alias("blocks"), tx.truncated(F.concat(F.lit(" part "), p.cast("string")), 7).alias("short"),
    )


@query(f"""with {FILES_SQL} select page_id, regexp_replace(printf('%06d', page_id) || '_' || name, '[^\\w\\-.]+', '_', 'g') as both, printf('%06d', page_id) as idx, case when path like '%.mp4' then 'image/png' end as mime, regexp_replace(name, '[^a-zA-Z0-9_\\-]+', '_', 'g') as ascii from g""")
def file_stems(spark: SparkSession, sf: str) -> DataFrame:
    f = url_files(spark, sf)
    n, p = F.col("page_id"), F.col("path")
    return f.select("page_id", jsonl.pretty_stem(n, p).alias("both"), jsonl.pretty_stem(n, p, "idx").alias("idx"), tx.mime_type(p).alias("mime"), tx.safe_ascii_stem(tx.norm_filename(p)).alias("ascii"))


@query("""select event_id, case when event_id % 3 = 0 then 2 when event_id % 3 = 1 then 1 end::bigint as n_figures, case when event_id % 3 <> 2 then user_id::bigint end as total,
  (case when event_id % 2 = 0 then event_id else user_id end)::bigint as line_no from events""")
def usage_and_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Token usage without nulls, and line numbers of which a row's own wins."""
    e, u = F.col("event_id"), F.col("user_id")
    usage = F.when(e % 3 == 0, F.format_string('{"total_token_count": %d, "prompt_token_count": 3, "other": 1}', u)).when(e % 3 == 1, F.format_string('{"total_token_count": %d, "prompt_token_count": null}', u)).otherwise("{}")
    raw = F.when(e % 2 == 0, F.format_string('{"line_no": %d}', e)).otherwise('{"a": 1}')
    m = records.token_usage(usage)
    return table(spark, sf, "events").select("event_id", F.when(m.isNotNull(), F.size(m)).cast("long").alias("n_figures"), F.try_element_at(m, F.lit("total_token_count")).alias("total"), records.numbered(raw, u).alias("line_no"))


@query("""select o_orderkey, 'p' || o_custkey || '.png' as path, case when o_orderkey % 3 = 2 then 40.0 else (o_orderkey % 50)::double end as x1, (case when o_orderkey % 3 = 1 then o_custkey % 40 when o_orderkey % 3 = 2 then 150 else 9 end)::double as y2, 'where ' || o_orderkey as question from orders""")
def unified(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both shapes: boxes of their own, boxes in image paths, and a normalised box that the model names."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.concat(F.lit("p"), c.cast("string"), F.lit(".png"))
    turn = lambda who, v: F.struct(F.lit(who).alias("from"), v.alias("value"))
    x = table(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 3 == 0, name).alias("image"), F.when(k % 3 == 0, F.concat(F.lit("where "), k.cast("string"))).alias("question"), F.when(k % 3 == 0, "here").alias("answer"),
        F.when(k % 3 == 0, F.array(F.array((k % 50).cast("double"), F.lit(1.0), F.lit(60.0), F.lit(9.0)))).alias("bboxs"), F.lit(200.0).alias("width"), F.lit(300.0).alias("height"),
        F.when(k % 3 == 1, F.array(name, F.concat(name, F.lit("###["), (k % 50).cast("string"), F.lit(", 1, 60, "), (c % 40).cast("string"), F.lit("]")))).when(k % 3 == 2, F.array(name)).alias("images"),
        F.array(turn("human", F.concat(F.lit("<image> where "), k.cast("string"), F.lit(" Please provide the box"))), turn("gpt", F.lit("[0.2, 0.1, 0.6, 0.5]")), turn("gpt", F.lit("there"))).alias("conversations"),
    )
    x = records.unified_rows(x)
    b = F.get("boxes", F.lit(0))
    return x.select("o_orderkey", "path", F.get(b, F.lit(0)).alias("x1"), F.get(b, F.lit(3)).alias("y2"), "question")


@query("""select doc_id, (case doc_id % 3 when 0 then 2 when 1 then 1 else 1 end)::bigint as n_lines, (case doc_id % 3 when 0 then 'a|b' when 1 then 'c' else 'd' end) as texts, 3::bigint as n_words, (case when doc_id % 2 = 0 then 1 else 0 end)::bigint as n_blank, 1::bigint as n_without_box from documents""")
def ocr_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines out of the three shapes of OCR documents, and words that have no use, counted."""
    d = F.col("doc_id")
    raw = F.when(d % 3 == 0, '{"LINE": [{"Id": "1", "Text": "a", "Confidence": 9.5}, 4, {"Text": "b"}]}').when(d % 3 == 1, '{"Blocks": [{"BlockType": "PAGE"}, {"BlockType": "LINE", "Text": "c"}], "x": [{"BlockType": "LINE"}]}').otherwise('{"P": [{"BlockType": "LINE", "Text": "d"}], "n": 3, "Q": [1, {"BlockType": "WORD"}]}')
    box = '"Geometry": {"BoundingBox": {"Left": 0.1, "Top": 0.1, "Width": 0.1, "Height": 0.1}}'
    words = F.concat(F.lit('{"WORD": [{"Id": "1", "Text": "'), F.when(d % 2 == 0, " ").otherwise("w"), F.lit(f'", {box}}}, {{"Id": "2", "Text": "v"}}, {{"Id": "3", "Text": "u", {box}}}]}}'))
    x = table(spark, sf, "documents").select("doc_id", raw.alias("raw"), words.alias("ocr"))
    lines = x.select("doc_id", ocr.line_blocks(F.col("raw")).alias("l"))
    return lines.select("doc_id", F.size("l").cast("long").alias("n_lines"), F.array_join(F.transform("l", lambda v: v["text"]), "|").alias("texts")).join(ocr.skipped_words(x), "doc_id")


@query("""select '{"n":' || count(*) || ',"least":' || min(o_orderkey) || ',"statuses":["' || (select string_agg(s, '","' order by s) from (select distinct o_orderstatus as s from orders)) || '"]}' as report from orders""")
def order_report(spark: SparkSession, sf: str) -> DataFrame:
    return jsonl.json_report(table(spark, sf, "orders"), n=F.count("*"), least=F.min("o_orderkey"), statuses=F.array_sort(F.collect_set("o_orderstatus")))


@query("""select count(*)::bigint as n, o_custkey % 2 = 0 as done from orders group by 2 having not done""")
def rows_left(spark: SparkSession, sf: str) -> DataFrame:
    """What is left after a run that has done the orders of every other customer."""
    o = table(spark, sf, "orders")
    left = jsonl.rows_left(o, o.where("o_custkey % 2 = 0").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])
    return left.groupBy((F.col("o_custkey") % 2 == 0).alias("done")).agg(F.count("*").alias("n"))


@query("""select c_custkey, case when c_custkey % 2 = 0 then '' else 'q' || c_custkey end as question, '' as answer, 'i' || c_custkey as image from customer""")
def payloads(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    x = table(spark, sf, "customer").select("c_custkey", F.when(k % 2 == 1, F.concat(F.lit("q"), k.cast("string"))).alias("question"), F.concat(F.lit("i"), k.cast("string")).alias("image"), F.lit("x").alias("extra"))
    return records.payload(x).select(F.substring("image", 2, 20).cast(x.schema["c_custkey"].dataType).alias("c_custkey"), "question", "answer", "image")
