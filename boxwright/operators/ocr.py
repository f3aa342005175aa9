"""OCR output of two shapes to word rows with norm1000 boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from boxwright.functions import geom

BLOCKS = "struct<LINE:array<struct<Id:string,Text:string,Relationships:array<struct<Type:string,Ids:array<string>>>>>,WORD:array<struct<Id:string,Text:string,Confidence:double,Geometry:struct<BoundingBox:struct<Left:double,Top:double,Width:double,Height:double>>>>>"
LINES = "array<struct<boundingBox:array<double>,text:string,words:array<struct<boundingBox:array<double>,text:string,confidence:string>>>>"
PAGES = "struct<status:string,recognitionResults:array<struct<page:int,width:double,height:double,unit:string,lines:array<struct<boundingBox:array<double>,text:string,words:array<struct<boundingBox:array<double>,text:string,confidence:string>>>>>>>"


def block_words(docs: DataFrame, digits: int = 2, line_map: bool = True, skip_empty_text: bool = False) -> DataFrame:
    """(doc_id, word_idx, text, confidence, bbox, line_idx, line_id, line_text) from (doc_id, ocr) of LINE and WORD blocks.

    word_idx counts all words of the document, unreadable ones too, which themselves have no row. The last line that lists
    a word is its line; lines without an id list none. A null text is empty."""
    x = docs.select("doc_id", F.from_json("ocr", BLOCKS).alias("o"))
    w = x.select("doc_id", F.posexplode("o.WORD").alias("word_idx", "w"))
    b = F.col("w.Geometry.BoundingBox")
    w = w.select("doc_id", "word_idx", F.col("w.Id").alias("_id"), F.coalesce("w.Text", F.lit("")).alias("text"), F.col("w.Confidence").alias("confidence"), geom.ltwh_to_norm1000(b["Left"], b["Top"], b["Width"], b["Height"], digits).alias("bbox")).where("bbox is not null")
    if skip_empty_text:
        w = w.where(F.trim("text") != "")
    if not line_map:
        return w.drop("_id")
    lines = x.select("doc_id", F.posexplode("o.LINE").alias("line_idx", "l")).where("l.Id is not null")
    child = lines.select("doc_id", "line_idx", "l.Id", "l.Text", F.explode(F.flatten(F.transform(F.filter("l.Relationships", lambda r: r["Type"] == "CHILD"), lambda r: r["Ids"]))).alias("_id"))
    last = child.groupBy("doc_id", "_id").agg(F.max(F.struct("line_idx", F.col("Id").alias("line_id"), F.col("Text").alias("line_text"))).alias("m"))
    return w.join(last, ["doc_id", "_id"], "left").select("doc_id", "word_idx", "text", "confidence", "bbox", "m.line_idx", "m.line_id", "m.line_text")


def page_words(docs: DataFrame, digits: int = 2, line_text: bool = False, skip_non_succeeded: bool = False) -> DataFrame:
    """(doc_id, page, line_idx, word_idx, word_in_line, text, bbox, unit, _src_level, confidence[, line_text]) from (doc_id, ocr) of pages.

    word_idx counts readable words over all pages; line_idx starts again on each page. A line without words is one word
    of its own (LINE_FALLBACK); one whose words are all unreadable has none. Pages without size have none."""
    x = docs.select("doc_id", F.from_json("ocr", PAGES).alias("o"))
    if skip_non_succeeded:
        status = F.lower(F.trim(F.coalesce("o.status", F.lit(""))))
        x = x.where((status == "succeeded") | (status == ""))
    level = lambda bare: F.when(bare, "LINE_FALLBACK").otherwise("WORD")

    def words_of(p: Column, at: Column, line: Column, i: Column) -> Column:
        bare = F.coalesce(F.size(line["words"]), F.lit(0)) <= 0
        own = F.array(F.struct(line["boundingBox"].alias("boundingBox"), line["text"].alias("text"), F.lit(None).cast("string").alias("confidence")))

        def word(w: Column, k: Column) -> Column:
            box = geom.pixel_to_norm1000(geom.poly_to_box(w["boundingBox"]), p["width"], p["height"], digits)
            return F.struct(p["page"].alias("page"), i.alias("line_idx"), k.alias("word_in_line"), F.coalesce(w["text"], F.lit("")).alias("text"), box.alias("bbox"), p["unit"].alias("unit"), level(bare).alias("_src_level"), w["confidence"].alias("confidence"), line["text"].alias("line_text"))

        return F.transform(F.when(bare, own).otherwise(line["words"]), word)

    # words are numbered in the document's own array: nothing is sorted or exchanged
    pages = F.filter("o.recognitionResults", lambda p: (p["width"] > 0) & (p["height"] > 0))
    every = F.flatten(F.flatten(F.transform(pages, lambda p, at: F.transform(F.coalesce(p["lines"], F.array().cast(LINES)), lambda line, i: words_of(p, at, line, i)))))
    w = x.select("doc_id", F.posexplode(F.filter(every, lambda v: v["bbox"].isNotNull())).alias("word_idx", "w"))
    cols = ["doc_id", "w.page", "w.line_idx", "word_idx", "w.word_in_line", "w.text", "w.bbox", "w.unit", "w._src_level", "w.confidence"]
    return w.select(*cols, *(["w.line_text"] if line_text else []))


def line_blocks(ocr: Column) -> Column:
    """Lines of an OCR document (JSON) as structs (id, text, confidence): the list LINE, or else all blocks of that type, of Blocks, of a bare
    list, or of any list in the object."""
    v = F.try_parse_json(ocr)
    listed = lambda x: F.coalesce(F.schema_of_variant(x).startswith("ARRAY"), F.lit(False))
    items = lambda x: F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array().cast("array<variant>"))
    at = lambda k: F.try_variant_get(v, f"$.{k}", "variant")
    every = F.flatten(F.transform(F.map_values(F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))), lambda x: F.when(listed(x), items(x)).otherwise(F.array().cast("array<variant>"))))
    blocks = F.when(listed(v), items(v)).when(listed(at("Blocks")), items(at("Blocks"))).otherwise(every)
    typed = F.filter(blocks, lambda x: F.coalesce(F.try_variant_get(x, "$.BlockType", "string") == "LINE", F.lit(False)))
    own = F.filter(items(at("LINE")), lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    lines = F.when(listed(at("LINE")), own).otherwise(typed)
    return F.transform(lines, lambda x: F.struct(F.try_variant_get(x, "$.Id", "string").alias("id"), F.coalesce(F.try_variant_get(x, "$.Text", "string"), F.lit("")).alias("text"), F.try_variant_get(x, "$.Confidence", "double").alias("confidence")))


def skipped_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_blank, n_without_box) of LINE and WORD blocks: what block_words() leaves out, counted."""
    x = docs.select("doc_id", F.from_json("ocr", BLOCKS)["WORD"].alias("w"))
    box = lambda w: geom.ltwh_to_norm1000(w["Geometry"]["BoundingBox"]["Left"], w["Geometry"]["BoundingBox"]["Top"], w["Geometry"]["BoundingBox"]["Width"], w["Geometry"]["BoundingBox"]["Height"])
    n = lambda f: F.coalesce(F.size(F.filter("w", f)), F.lit(0)).cast("long")
    return x.select("doc_id", n(lambda w: F.lit(True)).alias("n_words"), n(lambda w: F.trim(F.coalesce(w["Text"], F.lit(""))) == "").alias("n_blank"), n(lambda w: box(w).isNull()).alias("n_without_box"))
