"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Items of the benchmark are a stated query set: they are taken in blocks of bounded size, each block against all rows. A first
pass counts in how many documents each 3-word seed of the items occurs. A seed takes part if it is rare in the corpus, or if it
is in the rarer half of its item's seeds (so an item whose passage fills a third of the corpus still has seeds). The second
pass finds seeds in every whole text, gathers those of one item that lie near one another, and aligns the words around them
with the item's words: match +2, other word -1, gap -1. The score over its largest possible value, 2 per item word, is the
similarity; copies with edits, insertions and lost words keep most of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import table
from .words import Words, mix64, word_blocks
from .workers import lean

SEED = 3
#: Items with fewer words have no copies with edits: documents that hold their very sequence of words are found.
MIN_WORDS = 5
SIMILARITY = 0.5
MATCH, OTHER, GAP = 2, -1, -1
#: A seed is rare if at most this share of documents has it.
RARE_SHARE = 1e-3
#: Bytes of item text in one block.
ITEM_BYTES = 8 << 20


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    g = hashes[: len(hashes) - n + 1].copy()
    for t in range(1, n):
        g = mix64(g * np.uint64(0xD6E8FEB86659FD93) + hashes[t : len(hashes) - n + 1 + t])
    return g


class Items:
    """A block of items: word hashes of each, and its seeds as sorted (gram, item, place)."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = [np.concatenate([w.hash for _, _, w in word_blocks(pa.array([t]))]) for t in texts]
        short = sorted((len(w), int(_grams(w, len(w))[0]), i) for i, w in enumerate(words) if 0 < len(w) < MIN_WORDS)
        self.short = {n: (np.array([g for m, g, _ in short if m == n], np.uint64), [ids[i] for m, _, i in short if m == n]) for n in {m for m, _, _ in short}}
        keep = [i for i, w in enumerate(words) if len(w) >= MIN_WORDS]
        self.ids, self.words = [ids[i] for i in keep], [words[i] for i in keep]
        grams = [_grams(w, SEED) for w in self.words]
        self.gram = np.concatenate([np.zeros(0, np.uint64), *grams])
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
        self._sort()

    def _sort(self) -> None:
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.item, self.place = self.gram[order], self.item[order], self.place[order]

    def keep_rare(self, counts: dict[int, int], n_docs: int) -> None:
        """Leave out seeds that are both common in the corpus and in the commoner half of their item's."""
        df = np.array([counts.get(int(g), 0) for g in self.gram.view(np.int64)], np.int64)
        order = np.lexsort((self.place, df, self.item))
        start = np.searchsorted(self.item[order], np.arange(len(self.ids) + 1))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - start[self.item[order]]
        size = np.diff(start)[self.item]
        ok = (df <= RARE_SHARE * n_docs) | (2 * rank < size + 1)
        self.gram, self.item, self.place = self.gram[ok], self.item[ok], self.place[ok]

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, index of the seed) of all seeds in a block's rows."""
        g = _grams(w.hash, SEED)
        if not len(g) or not len(self.gram):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = w.row[: len(g)] == w.row[SEED - 1 :]
        low = np.searchsorted(self.gram, g)
        found = np.flatnonzero((self.gram[np.minimum(low, len(self.gram) - 1)] == g) & whole)
        n = np.searchsorted(self.gram, g[found], "right") - low[found]
        return np.repeat(found, n), np.repeat(low[found], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def align(item: np.ndarray, doc: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: (score, first word of doc, word after the last, equal words).

    Two rows of scores are held, each with where its alignment begins and how many words are equal, so memory is that of one row
    however long the item is. Of equal scores a pair of words goes before a gap.
    """
    n = len(doc)
    place, climb = np.arange(n, dtype=np.int64), np.arange(n, dtype=np.int64) * -GAP
    h, start, equal = np.zeros(n + 1, np.int64), np.arange(n + 1, dtype=np.int64), np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for word in item:
        same = doc == word
        pair, gap = h[:-1] + np.where(same, MATCH, OTHER), h[1:] + GAP
        x = np.maximum(np.maximum(pair, gap), 0)
        by_pair, none = pair >= gap, x == 0
        x_start = np.where(none, place + 1, np.where(by_pair, start[:-1], start[1:]))
        x_equal = np.where(none, 0, np.where(by_pair, equal[:-1] + same, equal[1:]))
        source = np.maximum.accumulate((x + climb) * (n + 1) + place) % (n + 1) if n else place  # gaps along the row
        row = x[source] + GAP * (place - source)
        h, start, equal = np.r_[0, row], np.r_[0, np.where(row > 0, x_start[source], place + 1)], np.r_[0, np.where(row > 0, x_equal[source], 0)]
        end = int(np.argmax(h))
        if h[end] > best[0]:
            best = (int(h[end]), int(start[end]), end, int(equal[end]))
    return best


def leaks_of_block(w: Words, items: Items) -> list[tuple[int, int, int, float, int, int, int]]:
    """(row, item id, score, similarity, first word, word after the last, equal words): the best passage of each item in each row."""
    exact = _whole(w, items)
    word, seed = items.hits(w)
    if not len(word):
        return exact
    row, item, place = w.row[word], items.item[seed], items.place[seed]
    order = np.lexsort((word, item, row))
    word, row, item, place = word[order], row[order], item[order], place[order]
    size = np.array([len(x) for x in items.words])[item]
    new = np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(word) > size[1:])]
    first = np.flatnonzero(new)
    best: dict[tuple[int, int], tuple] = {}
    for a, b in zip(first, np.r_[first[1:], len(word)], strict=True):
        m = int(size[a])
        # words of the document around the seeds, with room for a quarter of the item in insertions
        lo = max(int(w.bounds[row[a]]), int((word[a:b] - place[a:b]).min()) - m // 4 - 1)
        hi = min(int(w.bounds[row[a] + 1]), int((word[a:b] + m - place[a:b]).max()) + m // 4 + 1)
        score, i, j, equal = align(items.words[item[a]], w.hash[lo:hi])
        if score >= SIMILARITY * MATCH * m:
            base = int(w.bounds[row[a]])
            key, value = (int(row[a]), int(item[a])), (score, -(lo + i - base), lo + j - base, equal)
            best[key] = max(best.get(key, value), value)
    return exact + [(r, items.ids[t], s, s / (MATCH * len(items.words[t])), -i, j, equal) for (r, t), (s, i, j, equal) in sorted(best.items())]


def _whole(w: Words, items: Items) -> list[tuple]:
    """Short items whose words stand in a row, one after another: the first place of each."""
    out: dict[tuple[int, int, int], tuple] = {}
    for n, (known, ids) in items.short.items():
        g = _grams(w.hash, n)
        if not len(g):
            continue
        at = np.searchsorted(known, g)
        hit = np.flatnonzero((known[np.minimum(at, len(known) - 1)] == g) & (w.row[: len(g)] == w.row[n - 1 :]))
        for p in hit.tolist():
            r, k = int(w.row[p]), int(at[p])
            while k < len(known) and known[k] == g[p]:  # items of the same words
                first = p - int(w.bounds[r])
                out.setdefault((r, n, k), (r, ids[k], MATCH * n, 1.0, first, first + n, n))
                k += 1
    return sorted(out.values())


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The benchmark in blocks of about ITEM_BYTES; null ids and texts are left out."""
    b = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null and text is not null").distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // ITEM_BYTES))
    for i in range(n):
        rows = b.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).orderBy("item_id", "text").collect()
        if rows:
            yield Items([r[0] for r in rows], [r[1] for r in rows])


def _ready(docs: DataFrame, items: Items):
    """Keep an items block's rare seeds after a pass over the corpus; returns it as a broadcast (bounded by ITEM_BYTES)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        n = 0
        for batch in batches:
            n += batch.num_rows
            for _, _, w in word_blocks(batch.column(0)):
                word, seed = sent.value.hits(w)
                pairs = np.unique(np.stack([w.row[word], sent.value.gram[seed].view(np.int64)]), axis=1)
                for g, c in zip(*np.unique(pairs[1], return_counts=True), strict=True):
                    total[int(g)] = total.get(int(g), 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array([*total, None], pa.int64()), pa.array([*total.values(), n], pa.int64())], names=["gram", "n"])

    found = docs.mapInArrow(lean(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # a row for each seed of the block at most
    counts = {r[0]: r[1] for r in found}
    items.keep_rare(counts, counts.pop(None, 0) or 0)
    return spark.sparkContext.broadcast(items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, similarity, first_word, end_word, equal_words) for each item that a document holds.

    first_word and end_word count words of the whole text, from 0, the end excluded. Of several passages the best aligned one
    counts, of equal ones the first. Items of fewer than five words count where their very words stand in a row; items without words never.
    Null and empty texts hold nothing. Rows that repeat come out repeatedly. A text is worked on whole, in memory of some twenty times
    its bytes. An empty table, of documents or items, gives an empty one. Other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, score long, similarity double, first_word long, end_word long, equal_words long"
    out = None
    for items in item_blocks(benchmark):
        sent = _ready(src.select("text"), items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, _, w in word_blocks(batch.column(1)):
                    found = leaks_of_block(w, sent.value)
                    if found:
                        cols = list(zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(cols[0]) + i)), *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()), strict=True))], names=["doc_id", "item_id", "score", "similarity", "first_word", "end_word", "equal_words"])

        found = src.mapInArrow(lean(run), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of docs that hold no item, all columns as they were."""
    for items in item_blocks(benchmark):
        sent, at = _ready(docs.select(text_col), items), docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, at=at) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for i, _, w in word_blocks(batch.column(at)):
                    keep[[i + x[0] for x in leaks_of_block(w, sent.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
