"""Joins between rows, annotations, assets, targets and OCR lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from boxwright.functions.text import key_text, norm_filename, stem


def todo_rows(base: DataFrame, annotated: DataFrame, keys: list[str], failed: str = "failed", latest_wins: str | None = None) -> DataFrame:
    """Base rows whose key isn't annotated (`_why` missing) or has a failed annotation (failed). One failed annotation makes its key
    fail, unless latest_wins names the column that orders them. Base rows that repeat stay."""
    named = [key_text(F.col(k).cast("string")).alias(f"_k{i}") for i, k in enumerate(keys)]
    cols = [f"_k{i}" for i in range(len(keys))]
    bad = F.max_by(failed, latest_wins) if latest_wins else F.bool_or(failed)
    done = annotated.select(*named, "*").groupBy(*cols).agg(bad.alias("_failed"))
    x = base.select("*", *named).join(done, cols, "left")
    return x.where(F.col("_failed").isNull() | F.col("_failed")).withColumn("_why", F.when(F.col("_failed").isNull(), "missing").otherwise("failed")).drop("_failed", *cols)


def valid_assets(rows: DataFrame, images: DataFrame, ocr: DataFrame, image_key: str = "image", ocr_key: str | None = None) -> DataFrame:
    """Rows whose image and OCR files both exist. images, ocr: one column of names (of stems for OCR)."""
    o = F.col(ocr_key) if ocr_key else stem(F.col(image_key))
    x = rows.withColumn("_o", o)
    x = x.join(images.toDF("_i"), x[image_key] == F.col("_i"), "left_semi")
    return x.join(ocr.toDF("_s"), x["_o"] == F.col("_s"), "left_semi").drop("_o")


def missing_assets(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Distinct names that rows ask for and the listing lacks."""
    return rows.select(F.col(key).alias("name")).where("name is not null").distinct().join(names.toDF("name"), "name", "left_anti")


def rows_by_target(rows: DataFrame, targets: DataFrame, file_col: str, order: list[str], allow_duplicates: bool = False) -> DataFrame:
    """Rows whose normalised file name is a target; the first of each name by `order`, or all."""
    t = targets.select(norm_filename(F.col(targets.columns[0])).alias("_name")).distinct()
    x = rows.withColumn("_name", norm_filename(F.col(file_col))).join(t, "_name", "left_semi")
    if not allow_duplicates:
        x = x.withColumn("_n", F.row_number().over(Window.partitionBy("_name").orderBy(*order))).where("_n = 1").drop("_n")
    return x.withColumnRenamed("_name", "norm_name")


def missing_targets(rows: DataFrame, targets: DataFrame, file_col: str) -> DataFrame:
    """(norm_name, originals): targets that no row has, with all spellings, sorted."""
    t = targets.select(F.col(targets.columns[0]).alias("o")).withColumn("norm_name", norm_filename(F.col("o")))
    have = rows.select(norm_filename(F.col(file_col)).alias("norm_name")).distinct()
    return t.join(have, "norm_name", "left_anti").groupBy("norm_name").agg(F.array_sort(F.collect_set("o")).alias("originals"))


def copy_plan(targets: DataFrame, listing: DataFrame, existing: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """(target, src, action) for every target row: copy, skip where the destination exists or an earlier row makes it, or missing.

    listing: one column of paths; of paths with one normalised name the smallest counts. targets: (ord, target)."""
    files = listing.toDF("src").withColumn("name", norm_filename(F.col("src"))).groupBy("name").agg(F.min("src").alias("src"))
    x = targets.withColumn("name", norm_filename(F.col("target"))).join(files, "name", "left")
    x = x.withColumn("_n", F.row_number().over(Window.partitionBy("name").orderBy("ord")))
    there = F.lit(False)
    if existing is not None:
        x = x.join(existing.toDF("name").distinct().withColumn("_there", F.lit(True)), "name", "left")
        there = F.coalesce("_there", F.lit(False))
    action = F.when(F.col("src").isNull(), "missing").when(F.lit(not overwrite) & (there | (F.col("_n") > 1)), "skip").otherwise("copy")
    return x.select("ord", "target", "src", action.alias("action"))


def image_lookup(rows: DataFrame, listing: DataFrame, image: str, extensions: list[str]) -> DataFrame:
    """Adds `found`: the listed name that is the image itself, or else its stem with the first extension that is listed."""
    names = F.concat(F.array("_image"), F.array(*(F.concat(stem(F.col("_image")), F.lit(e)) for e in extensions)))
    wanted = rows.select(F.col(image).alias("_image")).distinct().select("_image", F.posexplode(names).alias("p", "name"))
    hit = wanted.join(listing.toDF("name").distinct(), "name").groupBy("_image").agg(F.min_by("name", "p").alias("found"))
    return rows.join(hit, rows[image] == hit["_image"], "left").drop("_image")


def line_windows(words: DataFrame, lines: int = 2, around: int = 120, doc: str = "doc_id", line: str = "line_idx", word: str = "word_idx") -> DataFrame:
    """(doc, line, lo, hi): first and last word on the lines within `lines` of each line; computed once a line, not once an anchor.

    Words without a line get a window of `around` words on either side in the matcher itself."""
    by_line = words.where(F.col(line).isNotNull()).groupBy(doc, line).agg(F.min(word).alias("a"), F.max(word).alias("b"))
    near = Window.partitionBy(doc).orderBy(line).rangeBetween(-lines, lines)
    return by_line.select(doc, line, F.min("a").over(near).alias("lo"), F.max("b").over(near).alias("hi"))


def line_clusters(matched: DataFrame, doc: str = "doc_id", line: str = "line_idx") -> DataFrame:
    """(doc, first_line, last_line, n_words): runs of matched words on lines without a gap of more than one."""
    w = Window.partitionBy(doc).orderBy(line)
    lines = matched.groupBy(doc, line).agg(F.count("*").alias("n"))
    new = F.when(F.col(line) - F.lag(line).over(w) <= 1, 0).otherwise(1)
    x = lines.withColumn("_new", new).withColumn("_c", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(doc, "_c").agg(F.min(line).alias("first_line"), F.max(line).alias("last_line"), F.sum("n").alias("n_words")).drop("_c")
