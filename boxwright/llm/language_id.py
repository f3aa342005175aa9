"""Language identification by Bayesian evidence fusion.

Evidence on a page's language: likelihoods of its visible text under byte-trigram models, the language that its markup declares,
the suffix of its address, and where else its host stands. Trigram models are counted over all labelled documents. A first pass
turns each text into a posterior; grouped sums of these give how languages declare themselves, how suffixes go
with languages, and host priors, smoothed from host to domain to suffix to all pages. A page's own share is taken out of its host's
sums before they judge it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import cut, table
from .words import blocks, text_buffers

#: Trigrams are counted in so many hashed cells.
CELLS = 1 << 14
#: Languages that a text is scored under at once.
LANGUAGE_BLOCK = 64
#: Neighbouring trigrams repeat each other's evidence: a text counts with this share of its log likelihood, up to MOST_NATS.
TEMPER, MOST_NATS = 0.3, 30.0
STRENGTH = 4.0

HIDDEN = re.compile(r"<(script|style|template|noscript)\b|<!--", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript")} | {"": re.compile("-->")}
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b|<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']\s*([A-Za-z]{2,3})\b", re.I)


def _cells(raw: np.ndarray) -> np.ndarray:
    """Hashed cell of the trigram that ends at each byte from the third."""
    low = (raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)).astype(np.uint32)
    return ((low[:-2] * np.uint32(0x1F1F1F) ^ low[1:-1] * np.uint32(0x9E3779B1) ^ low[2:] * np.uint32(0x85EBCA6B)) >> np.uint32(9)) % np.uint32(CELLS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        raw, offs = text_buffers(batch.column(1))
        langs = np.array(batch.column(0).to_pylist(), object)
        for i, j in blocks(offs):
            if offs[j] - offs[i] < 3:
                continue
            cell = _cells(raw[offs[i] : offs[j]])
            at = np.arange(len(cell)) + offs[i]
            row = np.searchsorted(offs, at, "right") - 1
            whole = at + 2 < offs[row + 1]
            for lang in set(langs[i:j]):
                mine = whole & (langs[row] == lang)
                total.setdefault(lang, np.zeros(CELLS, np.int64))
                total[lang] += np.bincount(cell[mine], minlength=CELLS)
    for lang, c in total.items():
        some = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(c[some])], names=["lang", "cell", "n"])


def train_text_model(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by cell) over all documents with a language. One row of 64 KB is collected for each language."""
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = cut(known.mapInArrow(_counts, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")), "trigrams")

    def one(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        n = np.full(CELLS, 0.5)
        n[t.column("cell").to_numpy()] += t.column("n").to_numpy()
        return pa.table({"lang": [key[0].as_py()], "logs": pa.array([np.log(n / n.sum()).astype("<f4").tobytes()], pa.binary())})

    found = sorted(counts.groupBy("lang").applyInArrow(one, "lang string, logs binary").collect())
    return [r[0] for r in found], np.stack([np.frombuffer(r[1], "<f4") for r in found]).astype(np.float64) if found else np.zeros((0, CELLS))


def visible_text(html: str) -> str:
    """html without hidden elements, comments and tags. One that is never closed hides nothing, and is looked for once."""
    out, at, open_for_good = [], 0, set()
    for m in HIDDEN.finditer(html):
        name = (m[1] or "").lower()
        if m.start() < at or name in open_for_good:
            continue
        end = ENDS[name].search(html, m.end())
        if end is None:
            open_for_good.add(name)
            continue
        out += [html[at : m.start()], " "]
        at = end.end()
    return TAG.sub(" ", "".join([*out, html[at:]]))


def _evidence(langs: list[str], logs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            post, declared = [], []
            for html in batch.column(1).to_pylist():
                html = html or ""
                raw = np.frombuffer(visible_text(html).encode(), np.uint8)
                cell = _cells(raw) if len(raw) > 2 else np.zeros(0, np.uint32)
                ll = np.concatenate([logs[k : k + LANGUAGE_BLOCK][:, cell].sum(axis=1) for k in range(0, len(langs), LANGUAGE_BLOCK)])
                ll = np.maximum(TEMPER * (ll - ll.max()), -MOST_NATS)
                post.append(np.exp(ll) / np.exp(ll).sum())
                m = DECLARED.search(html)
                declared.append((m[1] or m[2]).lower() if m else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(post, pa.list_(pa.float64())), pa.array(declared, pa.string())], names=["page_id", "url", "post", "declared"])

    return run


def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(n)]


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, lang, confidence, text_lang, text_confidence, declared, host, suffix): a row for every row of pages.

    A null or empty page has no text evidence and takes what its address and the priors say; a null address has no host. Ties go to
    the language that comes first in the alphabet. Without labelled documents lang and confidence are null. Other columns are ignored.
    """
    langs, logs = train_text_model(docs)
    n = len(langs)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"), F.col(url_col).alias("url"))
    if not n:
        return src.select("page_id", *(F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("confidence", "double"), ("text_lang", "string"), ("text_confidence", "double"), ("declared", "string"), ("host", "string"), ("suffix", "string"))))
    rows = src.mapInArrow(_evidence(langs, logs), "page_id long, url string, post array<double>, declared string")
    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = rows.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
    rows = cut(rows.withColumn("domain", F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1)).drop("url"), "evidence")
    everywhere = rows.agg(*_sums(n)).first()
    total = [x or 0.0 for x in everywhere]
    prior = [(x + 1) / (sum(total) + n) for x in total]

    def shares(key: str) -> DataFrame:
        """Sums by key. The tables are as long as there are keys; joins are left to the planner."""
        s = rows.groupBy(key).agg(*_sums(n))
        return cut(s.select(key, F.array(*(f"s{i}" for i in range(n))).alias(f"{key}_sum")), "shares")  # its own exchange: Spark splits a hot key's pages

    x = rows
    for key in ("suffix", "domain", "host"):
        x = x.join(shares(key), key, "left").withColumn(f"{key}_n", F.aggregate(f"{key}_sum", F.lit(0.0), lambda a, v: a + v))
    kinds = cut(rows.where("declared is not null").groupBy("declared").agg(*_sums(n)).select("declared", F.array(*(f"s{i}" for i in range(n))).alias("declared_sum")), "shares")
    x = x.join(kinds, "declared", "left")

    def smoothed(i: int) -> Column:
        """Prior of language i: its share at the host, pulled to the domain's, that to the suffix's, that to all pages'."""
        p: Column = F.lit(prior[i])
        for key in ("suffix", "domain", "host"):
            own = F.greatest(F.col(f"{key}_sum")[i] - F.col("post")[i], F.lit(0.0))
            count = F.greatest(F.col(f"{key}_n") - 1, F.lit(0.0))
            p = (own + STRENGTH * p) / (count + STRENGTH)
        return p

    def says(i: int) -> Column:
        """How likely pages of language i declare what this page declares; neutral where it declares nothing."""
        own = F.greatest(F.col("declared_sum")[i] - F.col("post")[i], F.lit(0.0)) + STRENGTH * F.when(F.col("declared") == langs[i], 1.0).otherwise(0.05)
        return F.when(F.col("declared").isNull(), F.lit(1.0)).otherwise(own / (total[i] + STRENGTH))

    weights = F.array(*(F.log(F.greatest(F.col("post")[i], F.lit(1e-13))) + F.log(smoothed(i)) + F.log(F.greatest(says(i), F.lit(1e-9))) for i in range(n)))
    x = x.withColumn("w", weights).withColumn("top", F.array_max("w"))
    x = x.withColumn("mass", F.aggregate("w", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("top"))))
    names = F.array(*(F.lit(k) for k in langs))
    pick = lambda c, m: F.element_at(names, F.array_position(c, m).cast("int"))
    return x.select("page_id", pick(F.col("w"), F.col("top")).alias("lang"), (1 / F.col("mass")).alias("confidence"), pick(F.col("post"), F.array_max("post")).alias("text_lang"), F.array_max("post").alias("text_confidence"), "declared", "host", "suffix")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
