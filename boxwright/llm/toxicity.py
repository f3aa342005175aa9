"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another: the labels have two, poor quality and toxic, so the chain has two links. Each model sees hashed words and word beginnings of the text and the logits of all
earlier categories; in training those logits are out of fold, as they come for new texts. The fit takes a bounded sample
of labelled rows and runs in one task; scoring takes every whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import table
from .words import Words, mix64, span_hash, word_blocks
from .workers import lean

#: Most labelled rows that a fit takes, drawn by a hash of their ids; all are taken where there are fewer.
FIT_ROWS = 10_000
#: Most features that a model keeps: those that tell a category's rows best.
MAX_FEATURES = 40_000
FOLDS = 5
#: A threshold whose rejections are right less often, out of fold, isn't taken; without any other nothing is rejected.
LEAST_PRECISION = 0.5
SPACE_BITS = 22
PREFIXES = (4, 5, 6)
SIGNS = np.isin(np.arange(256), np.frombuffer(b".,;:!?*$%&#)'\"", np.uint8))


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word without its closing signs, and of its first 4, 5 and 6 bytes; with repeats."""
    rows, out = [w.row], [w.hash]
    if len(w.start):
        last = len(w.low) - 1
        end, signs = w.end.copy(), np.zeros(len(w.low), bool)
        for _ in range(4):
            sign = SIGNS[w.low[end - 1]] & (end - w.start > 1)
            end -= sign
            signs[end[sign]] = True
        out = [span_hash(w.low, w.start, (w.low > 32) & ~signs)]
        head = np.zeros(len(w.start), np.uint64)
        for i in range(max(PREFIXES)):
            inside = w.start + i < w.end
            head = head * np.uint64(257) + (w.low[np.minimum(w.start + i, last)] + np.uint64(1)) * inside
            if i + 1 in PREFIXES:
                long = w.end - w.start > i + 1
                rows.append(w.row[long])
                out.append(mix64(head[long] + np.uint64(i)))
    return np.concatenate(rows), (np.concatenate(out) >> np.uint64(64 - SPACE_BITS)).astype(np.int64)


def _distinct(row: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(row << SPACE_BITS | f)
    return key >> SPACE_BITS, key & ((1 << SPACE_BITS) - 1)


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, where each begins) of sorted values."""
    at = np.flatnonzero(np.r_[np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])
    return values[at], at


def _counts(f: np.ndarray) -> np.ndarray:
    """How often each feature occurs. bincount takes 64-bit numbers, so it gets a part at a time."""
    out = np.zeros(1 << SPACE_BITS, np.int32)
    for i in range(0, len(f), 1 << SPACE_BITS):
        out += np.bincount(f[i : i + (1 << SPACE_BITS)], minlength=len(out)).astype(np.int32)
    return out


def _logistic(row: np.ndarray, col: np.ndarray, n: int, m: int, dense: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 60, memory: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Weights of m sparse 0/1 features and of dense columns (the last one is the bias), by L-BFGS on the convex penalised loss. Rows are sorted;
    sums by row and by feature run over spans."""
    by_col = np.argsort(col, kind="stable")
    row_of, col_of = row[by_col].astype(np.int32), col.astype(np.int32, copy=False)
    some_rows, row_at = _spans(row)
    some_cols, col_at = _spans(col[by_col])
    del by_col

    def sums(values: np.ndarray, at: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        if len(at):
            out[places] = np.add.reduceat(values, at)
        return out

    x = np.zeros(m + dense.shape[1])
    x[-1] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = sums(x[col_of], row_at, some_rows, n) + dense @ x[m:]
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        value = np.logaddexp(0, z).sum() - y @ z + l2 / 2 * (x[:m] @ x[:m])
        return value, np.r_[sums(g[row_of], col_at, some_cols, m) + l2 * x[:m], g @ dense]

    value, grad = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(grad).max() < 2e-3 * max(1.0, n**0.5):
            break
        q, alphas = grad.copy(), []
        for s, t, rho in reversed(pairs):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * t
        q *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.abs(grad).sum() ** 0.5)
        for (s, t, rho), alpha in zip(pairs, reversed(alphas), strict=True):
            q += s * (alpha - rho * (t @ q))
        slope, step = -(grad @ q), 1.0
        while True:  # halve until the loss falls enough
            new_value, new_grad = loss(x - step * q)
            if new_value <= value + 1e-4 * step * slope or step < 1e-6:
                break
            step /= 2
        s, t = -step * q, new_grad - grad
        if s @ t > 1e-10:
            pairs = [*pairs[-memory + 1 :], (s, t, 1 / (s @ t))]
        x, value, grad = x + s, new_value, new_grad
    return x[:m], x[m:]


def _select(row: np.ndarray, f: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Features that at least three rows have, the most telling by a two-proportion score; sorted."""
    every = _counts(f)
    some = np.flatnonzero(every >= 3)
    every = every[some]
    pos = _counts(f[(y > 0.5)[row]])[some]
    share = y.mean()
    z = np.abs((pos - every * share) / np.sqrt(every * share * (1 - share) + 1.0))
    some, z = some[z > 2], z[z > 2]
    return np.sort(some[np.argsort(-z, kind="stable")[:MAX_FEATURES]])


def _places(chosen: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in chosen, whether it is there) of each feature."""
    place = np.full(1 << SPACE_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    at = place[f]
    return at, at >= 0


def fit_chain(rows: np.ndarray, feats: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> dict:
    """labels: rows x categories of 0/1. Returns features, weights by category, the weights of earlier logits and bias, thresholds."""
    n, k = labels.shape
    dense, models, thresholds, f1s = np.ones((n, 1)), [], [], []
    for c in range(k):
        y = labels[:, c].astype(float)
        oof = np.zeros(n)
        for part in range(FOLDS + 1):  # the last one is fitted on all rows
            own = fold != part
            if not own.any():
                continue
            place = (np.cumsum(own) - 1).astype(np.int32)
            keep = own[rows]
            r, f = place[rows[keep]], feats[keep]
            chosen = _select(r, f, y[own])
            at, hit = _places(chosen, f)
            r, at = r[hit], at[hit]
            del keep, f, hit
            w, v = _logistic(r, at, int(own.sum()), len(chosen), dense[own], y[own])
            del r, at
            if part == FOLDS:
                models.append((chosen, w, v))
            else:
                at, hit = _places(chosen, feats)
                hit &= ~own[rows]
                z = np.bincount(rows[hit], w[at[hit]], n) + dense @ v
                oof[~own] = z[~own]
        order = np.argsort(-oof, kind="stable")
        good = np.cumsum(y[order])
        f1 = 2 * good / (np.arange(1, n + 1) + max(y.sum(), 1))
        f1[good / np.arange(1, n + 1) < LEAST_PRECISION] = 0
        f1[:-1][oof[order[:-1]] == oof[order[1:]]] = 0  # a threshold can't part equal logits
        best = int(np.argmax(f1))
        thresholds.append(float((oof[order[best]] + oof[order[min(best + 1, n - 1)]]) / 2) if f1[best] > 0 else float("inf"))
        f1s.append(float(f1[best]))
        dense = np.c_[np.clip(oof, -8, 8), dense]
    return {"models": models, "thresholds": thresholds, "f1": f1s}


def _fit_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, feats, labels, ids, n = [], [], [], [], 0
        for batch in batches:
            for i, j, w in word_blocks(batch.column(1)):
                r, f = _distinct(*features(w))
                rows.append((r + n).astype(np.int32))
                feats.append(f.astype(np.int32))
                n += j - i
            ids.append(batch.column(0).to_numpy().copy())  # a view would hold the batch with its texts
            labels.append(np.stack([batch.column(2 + c).to_numpy() for c in range(k)], axis=1))
        if not n:
            return
        del batch, w
        key = np.concatenate(ids)
        order = np.argsort(key, kind="stable")  # the fit doesn't depend on the order of arrival
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        pairs = place[np.concatenate(rows)] << SPACE_BITS
        pairs |= np.concatenate(feats)
        rows.clear()
        feats.clear()
        pairs.sort()
        r, f = (pairs >> SPACE_BITS).astype(np.int32), (pairs & ((1 << SPACE_BITS) - 1)).astype(np.int32)
        del pairs
        fold = (mix64(key[order].astype(np.uint64)) % np.uint64(FOLDS)).astype(int)
        model = fit_chain(r, f, np.concatenate(labels)[order], fold)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return run


def fit(docs: DataFrame, labels: DataFrame, categories: list[tuple[str, Column]], id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS) -> dict | None:
    """A chain fitted on at most about fit_rows labelled rows (twice as many are never reached). None without labelled rows.

    Rows of labels without id or with a null category are ignored; of labels that repeat an id the largest value counts.
    """
    spark = docs.sparkSession
    cols = [c.cast("int").alias(f"y{i}") for i, (_, c) in enumerate(categories)]
    y = labels.select(F.col(id_col).cast("long").alias("doc_id"), *cols).groupBy("doc_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(cols))))
    y = y.where(" and ".join(["doc_id is not null", *(f"y{i} is not null" for i in range(len(cols)))]))
    total = y.count()
    if not total:
        return None
    share = min(1.0, fit_rows / total)
    sample = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = known.join(F.broadcast(sample), "doc_id")  # bounded by fit_rows
    found = rows.select("doc_id", "text", *(f"y{i}" for i in range(len(cols)))).repartition(1).mapInArrow(lean(_fit_task(len(cols))), "model binary").collect()
    return pickle.loads(found[0][0]) | {"names": [n for n, _ in categories]} if found else None


def score_block(w: Words, model: dict) -> list[np.ndarray]:
    """Logits of each category for the rows of a block."""
    row, f = features(w)
    dense, out = np.ones((w.n_rows, 1)), []
    if "mask" not in model:
        mask = np.zeros(1 << SPACE_BITS, bool)
        for chosen, _, _ in model["models"]:
            mask[chosen] = True
        model["mask"] = mask
    hit = model["mask"][f]
    row, f = _distinct(row[hit], f[hit])
    for chosen, weight, v in model["models"]:
        at = np.searchsorted(chosen, f)
        own = np.r_[chosen, -1][at] == f
        z = np.bincount(row[own], weight[at[own]], w.n_rows) + dense @ v
        out.append(z)
        dense = np.c_[np.clip(z, -8, 8), dense]
    return out


def toxicity(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_<category>..., rejected): the chain's probabilities, and whether the last category passes its threshold.

    One row for every row of docs, in any order. A null or empty text gets what the intercepts give. Without a model the
    probabilities are null and nothing is rejected. Other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return src.select("doc_id", *(F.lit(None).cast("double").alias(f"p_{n}") for n, _ in label_categories()), F.lit(False).alias("rejected"))
    names = model["names"]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_FEATURES for each category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for i, j, w in word_blocks(batch.column(1)):
                z = score_block(w, m)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30)))) for x in z), pa.array(z[-1] >= m["thresholds"][-1])], names=["doc_id", *(f"p_{x}" for x in names), "rejected"])

    return src.mapInArrow(lean(run), "doc_id long, " + "".join(f"p_{x} double, " for x in names) + "rejected boolean")


def drop_toxic(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """Rows of docs that the chain doesn't reject, all columns as they were; rows that repeat an id are judged each by its text."""
    if model is None:
        return docs
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [score_block(w, sent.value)[-1] < sent.value["thresholds"][-1] for _, _, w in word_blocks(batch.column(at))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(lean(run), docs.schema)


def label_categories() -> list[tuple[str, Column]]:
    """The chain over the labels table: poor quality first, then toxicity."""
    return [("low_quality", 1 - F.col("quality")), ("toxic", F.col("toxic"))]


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit(docs, table(spark, sf_dir, "labels"), label_categories()))
