"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct k-word shingles (fewer words: the whole sequence). Each shingle hash falls into one
of 256 buckets by its top bits; a bucket keeps its smallest remaining hash as a leading-zero count and 10 mantissa bits
(16 bits together). Empty buckets borrow the register of a bucket drawn by a fixed random sequence. 32 bands of 4
registers make candidates: at a similarity of 0.75 a pair shares no band with probability (1 - 0.75^4)^32 = 5e-6. All 256
registers then give a similarity corrected for chance collisions of compressed registers; pairs that may reach the
threshold are confirmed on their full shingle sets, read again from the texts.

Equal sets are one node. In each band bucket every member is first held against one hub: the member that meets the most
others over all bands, which in a family of edited copies is the text that they were copied from. The components of
confirmed links follow. What is left are buckets whose members lie in several components. There, what lies outside the bucket's largest
component is held against the rest by registers, block against block in numpy, and a spanning set of the pairs of components that may
reach the threshold ties them into families. In a family, every member outside its largest component is confirmed against all
members of other components, block against block with the texts at hand, so that no row per pair is ever made and members of one
component are never compared. So every candidate pair either is tested or joins nodes that are linked already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .components import components
from .shared import cut, discard, table
from .words import mix64, shingles, word_blocks
from .workers import lean

BUCKETS, BANDS, ROWS, MANTISSA = 256, 32, 4, 10
#: Members of a bucket that one block holds when what is left is compared.
SIDE = 256
#: Shingles that one block holds when families are confirmed.
SIDE_SHINGLES = 1_000_000
#: Registers alone reject a pair only below the threshold less this (4.8 standard deviations at the
#: threshold), and not where fewer shingles make the estimate coarser.
SLACK, SMALL = 0.13, 24

_probe = None


def _probes() -> np.ndarray:
    """For each bucket, the order in which it asks the others when it is empty: a fixed random permutation."""
    global _probe
    if _probe is None:
        i = np.arange(BUCKETS * BUCKETS, dtype=np.uint64)
        _probe = np.argsort(mix64(i + np.uint64(77)).reshape(BUCKETS, BUCKETS), axis=1, kind="stable")
    return _probe


def registers(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """n_rows x BUCKETS uint16 registers of sorted distinct (row, hash); a row without hashes gets zeros."""
    shift = np.uint64(64 - 8)
    cell = rows.astype(np.int64) * BUCKETS + (hashes >> shift).astype(np.int64)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    value = hashes[first] << np.uint64(8)  # the rest of the hash, from its top bit; ties of lower bits don't matter
    full = np.zeros(n_rows * BUCKETS, np.uint16)
    if len(first):
        # exponent and fraction by way of the top 53 bits as a double: 2^e * 1.m
        top = (value >> np.uint64(11)).astype(np.float64)
        frac, exp = np.frexp(np.maximum(top, 1))
        zeros = (53 - exp).astype(np.uint16)
        mantissa = ((frac - 0.5) * (2 << MANTISSA)).astype(np.uint16)
        full[cell[first]] = ((zeros + 1) << MANTISSA) | mantissa
    full = full.reshape(n_rows, BUCKETS)
    out, need = full.copy(), full == 0
    some = full.any(axis=1)
    need[~some] = False
    probes = _probes()
    for step in range(BUCKETS):
        r, c = np.nonzero(need)
        if not len(r):
            break
        got = full[r, probes[c, step]]
        out[r, c] = got
        need[r, c] = got == 0
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """len(regs) x BANDS int64 keys."""
    quad = regs.reshape(len(regs), BANDS, BUCKETS // BANDS)[:, :, :ROWS].astype(np.uint64)
    key = np.zeros((len(regs), BANDS), np.uint64)
    for t in range(ROWS):
        key = (key << np.uint64(16)) | quad[:, :, t]
    return mix64(mix64(key.ravel()).reshape(key.shape) + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def collision_rate(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Chance that registers of unrelated sets agree: minima of m = n/BUCKETS values each, kept to a relative 2^-MANTISSA.

    The minimum of m values has density m(1-x)^(m-1). Two minima with rates p and q lie in one cell of relative width w
    with probability of about w * integral of x f(x) g(x) = w p q / (p + q)^2 for exponential minima, the mean cell being
    0.72 * 2^-MANTISSA wide against its lower edge.
    """
    p, q = np.maximum(na / BUCKETS, 1.0), np.maximum(nb / BUCKETS, 1.0)
    return 0.72 * 2.0**-MANTISSA * p * q / (p + q) ** 2


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate from registers."""
    same = (a == b).mean(axis=-1)
    c = collision_rate(na, nb)
    return np.clip((same - c) / (1 - c), 0, 1)


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(2)
            for i, j, w in word_blocks(batch.column(1)):
                row, h = shingles(w, k)
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
                row, h = row[new], h[new]
                n = np.bincount(row, minlength=j - i)
                edge = np.r_[0, np.cumsum(n)]
                k1, k2 = (np.r_[np.uint64(0), np.cumsum(mix64(h + np.uint64(s)), dtype=np.uint64)] for s in (1, 2))
                regs = registers(row, h, j - i)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), texts.slice(i, j - i), pa.array(n.astype(np.int64)), pa.array((k1[edge[1:]] - k1[edge[:-1]]).view(np.int64)), pa.array((k2[edge[1:]] - k2[edge[:-1]]).view(np.int64)), pa.array([x.tobytes() for x in regs], pa.binary())],
                    names=["doc_id", "h", "n_shingles", "k1", "k2", "sig"],
                )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.stack([np.frombuffer(x, np.uint16) for x in batch.column(2).to_pylist()])
        keys = band_keys(regs)
        rep, n = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rep), pa.array(n)], names=["band", "rep", "n"])


def _likely(threshold: float):
    """Pairs (a, b, na, nb, sa, sb) whose registers may belong to sets of that similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            sa, sb = (np.stack([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()]) for c in (4, 5))
            ok = (similarity(sa, sb, na, nb) >= threshold - SLACK) | (np.minimum(na, nb) < SMALL)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    return run


def _confirm(k: int, percent: int):
    """Pairs (a, b, text_a, text_b) that reach the similarity on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            keep = []
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, last_set = a[i], _set(ta.slice(i, 1), k)
                other = _set(tb.slice(i, 1), k)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(last_set) + len(other) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return run


def _set(col: pa.Array, k: int) -> np.ndarray:
    return np.unique(np.concatenate([shingles(w, k)[1] for _, _, w in word_blocks(col)] or [np.zeros(0, np.uint64)]))


class _Sets:
    """Union-find over a block's members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _close(x: int, y: np.ndarray, n: np.ndarray, sig: np.ndarray, threshold: float) -> np.ndarray:
    """Those of y whose registers and sizes allow a link with x."""
    y = y[np.minimum(n[y], n[x]) >= threshold * np.maximum(n[y], n[x]) - 1e-9]
    if not len(y):
        return y
    return y[(similarity(sig[x][None, :], sig[y], n[x], n[y]) >= threshold - SLACK) | (np.minimum(n[x], n[y]) < SMALL)]


def _across(threshold: float):
    """Of a block pair's members (side, rep, n, comp, sig): a spanning set of the pairs of components that may be linked."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        side, rep, n, comp = (t.column(c).to_numpy() for c in ("side", "rep", "n", "comp"))
        sig = np.stack([np.frombuffer(x, np.uint16) for x in t.column("sig").to_pylist()])
        _, node = np.unique(comp, return_inverse=True)
        left, right, tree, out = np.flatnonzero(side != 1), np.flatnonzero(side != 0), _Sets(int(node.max()) + 1), []
        for x in left:
            y = right[node[right] != node[x]]
            out += [(rep[x], rep[z]) for z in _close(x, y, n, sig, threshold) if tree.join(int(node[x]), int(node[z]))]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _within(k: int, percent: int):
    """Of a family's block pair (side, rep, n, comp, sig, text): a spanning set of its links across components."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        side, rep, n, comp = (t.column(c).to_numpy() for c in ("side", "rep", "n", "comp"))
        sig = np.stack([np.frombuffer(x, np.uint16) for x in t.column("sig").to_pylist()])
        col = t.column("text").chunk(0) if isinstance(t.column("text"), pa.ChunkedArray) else t.column("text")
        sets = [_set(col.slice(i, 1), k) for i in range(len(rep))]
        _, node = np.unique(comp, return_inverse=True)
        left, right, tree, out = np.flatnonzero(side != 1), np.flatnonzero(side != 0), _Sets(int(node.max()) + 1), []
        for x in left:
            y = _close(x, right[comp[right] != comp[x]], n, sig, percent / 100)
            y = y[np.fromiter((tree.find(int(c)) != tree.find(int(node[x])) for c in node[y]), bool, len(y))]
            if not len(y):
                continue
            size = np.fromiter((len(sets[z]) for z in y), np.int64, len(y))
            every, own = np.concatenate([sets[z] for z in y]), sets[x]
            hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            for z in y[100 * both >= percent * (len(own) + size - both)]:
                if tree.join(int(node[x]), int(node[z])):
                    out.append((rep[x], rep[z]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _dealt(x: DataFrame, key: str) -> DataFrame:
    """Members (key, rep, n, comp, ...) of several components a key, dealt into pairs of blocks (i, j) with the side that a member takes.

    Blocks 0 to others - 1 hold what lies outside the key's largest component, the following ones the largest component, which meets
    the others only.
    """
    sizes = x.groupBy(key, "comp").agg(F.count("*").alias("g"), F.sum("n").alias("w"))
    sizes = sizes.groupBy(key).agg(F.max(F.struct("g", "comp", "w")).alias("m"), F.sum("g").alias("g"), F.sum("w").alias("w"))
    parts = lambda g, w: F.greatest(F.ceil(g / SIDE), F.ceil(w / SIDE_SHINGLES), F.lit(1)).cast("int")
    sizes = sizes.select(key, F.col("m.comp").alias("main"), parts(F.col("m.g"), F.col("m.w")).alias("mains"), parts(F.col("g") - F.col("m.g"), F.col("w") - F.col("m.w")).alias("others"))
    x = x.join(sizes, key)
    main = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(main, F.col("mains")).otherwise(F.col("others"))).cast("int") + F.when(main, F.col("others")).otherwise(0)
    x = x.withColumn("own", own)
    against = F.when(main, F.sequence(F.lit(0), F.col("others") - 1)).otherwise(F.sequence(F.lit(0), F.col("others") + F.col("mains") - 1))
    x = x.withColumn("other", F.explode(against))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return x.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), "rep", "n", "comp")


def _family_links(near: DataFrame, comp1: DataFrame, sigs: DataFrame, src: DataFrame, k: int, percent: int) -> DataFrame:
    """Links across components inside the families that `near` pairs tie together."""
    tied = components(near.unionAll(comp1.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    touched = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    touched = touched.join(tied, "node", "left").select(F.coalesce("component", "node").alias("component")).distinct()
    fam = tied.unionAll(tied.select(F.col("component").alias("node"), "component")).distinct().join(touched, "component").select(F.col("component").alias("family"), F.col("node").alias("rep"))
    fam = fam.join(comp1.select(F.col("node").alias("rep"), F.col("component").alias("c")), "rep", "left").join(sigs, "rep").select("family", "rep", "n", "doc", "h", F.coalesce("c", "rep").alias("comp"))
    fam = cut(fam, "families")
    x = _dealt(fam.select("family", "rep", "n", "comp"), "family")
    texts = cut(_texts(src, fam.select("rep", "doc", "h")), "texts")
    full = x.join(sigs.select("rep", "sig").join(texts, "rep"), "rep")
    out = cut(full.groupBy("family", "i", "j").applyInArrow(_within(k, percent), "a long, b long"), "links")
    discard(texts)
    discard(fam)
    return out


def _texts(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, text) for (rep, doc, h): of rows that repeat an id, one with that very text."""
    found = src.withColumnRenamed("doc_id", "doc").join(wanted, ["doc", "h"])
    return found.groupBy("rep").agg(F.any_value("text").alias("text"))


def _decided(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(doc_id, h, n_shingles, component_id) for every row with an id; h is a hash of the row's text."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h")).where("doc_id is not null")
    threshold = percent / 100
    sketch = src.mapInArrow(lean(_sketch(k)), "doc_id long, h long, n_shingles long, k1 long, k2 long, sig binary")
    sketch = cut(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")  # numbers are fixed once they are written
    same = sketch.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct("row", "doc_id", "h", "sig")).alias("m"), F.min("doc_id").alias("least"))
    reps = cut(same.select("k1", "k2", F.col("m.row").alias("rep"), F.col("m.doc_id").alias("doc"), F.col("m.h").alias("h"), F.col("n_shingles").alias("n"), F.col("m.sig").alias("sig"), "least"), "reps")
    bands = reps.select("rep", "n", "sig").mapInArrow(_bands, "band long, rep long, n long")
    many = bands.groupBy("band").agg(F.count("*").alias("g")).where("g > 1")
    members = cut(bands.join(many, "band"), "members")  # of buckets with several members: few of all
    meets = members.groupBy("rep").agg(F.sum("g").alias("meets"))
    hubs = members.join(meets, "rep").groupBy("band").agg(F.max(F.struct("meets", (-F.col("rep")).alias("minus"))).alias("h")).select("band", (-F.col("h.minus")).alias("hub"))
    sigs = reps.select("rep", "n", "doc", "h", "sig")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """pairs: distinct (a, b)."""
        ids = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select(F.col("b").alias("rep"))).distinct()
        texts = cut(_texts(src, ids.join(sigs.select("rep", "doc", "h"), "rep")), "texts")
        full = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
        full = full.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
        out = cut(full.select("a", "b", "ta", "tb").mapInArrow(_confirm(k, percent), "a long, b long"), "links")
        discard(texts)
        return out

    def likely(pairs: DataFrame) -> DataFrame:
        x = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
        x = x.join(sigs.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")
        x = x.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        return x.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_likely(threshold), "a long, b long")

    first = members.join(hubs, "band").where("rep <> hub").select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b")).distinct()
    pairs1 = cut(likely(first), "pairs")
    links1 = confirmed(pairs1)
    comp1 = components(links1)

    # what is left: buckets whose members lie in several components
    named = members.join(comp1.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep", "left")
    named = named.select("band", "rep", "n", F.coalesce("comp", "rep").alias("comp"))
    mixed = named.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
    left = _dealt(cut(named.join(mixed, "band"), "mixed"), "band").join(sigs.select("rep", "sig"), "rep")
    near = left.groupBy("band", "i", "j").applyInArrow(_across(threshold), "a long, b long")
    near = cut(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
    links = links1
    if not near.isEmpty():
        links = links1.unionAll(_family_links(near, comp1, sigs, src, k, percent))
    comp = components(links)
    known = comp.unionAll(comp.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "rep")
    tops = known.join(reps.select("rep", "least"), "rep")
    tops = cut(tops.join(tops.groupBy("component").agg(F.min("least").alias("top")), "component").select("rep", "top"), "tops")
    of_set = reps.join(tops, "rep", "left").select("k1", "k2", F.col("n").alias("n_shingles"), F.coalesce("top", "least").alias("component"))
    out = sketch.drop("sig", "row").join(of_set, ["k1", "k2", "n_shingles"], "left")
    for x in (members, pairs1, near):
        discard(x)
    return out.select("doc_id", "h", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row with an id.

    component_id is the smallest id that a document reaches by links of at least percent/100 shared shingles; a null or
    empty text has no shingles, no link and its own id. kept marks the smallest id of each component. Rows without id are
    left out; rows that repeat an id come out once each, judged by their own texts. A text is worked on whole, in memory of some
    twenty times its bytes. An empty table gives an empty one. Other columns are ignored.
    """
    out = _decided(docs, id_col, text_col, k, percent).drop("h")
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row of each component of near-duplicates, all columns as they were: the one with the smallest id.

    Rows are dropped by id and text, so another text under the same id stays. Of rows that repeat both, one stays. Rows without id, or
    without words, stay.
    """
    rows = cut(_decided(docs, id_col, text_col, k, percent).where("n_shingles > 0"), "decided")
    gone = rows.where("doc_id <> component_id").select("doc_id", "h").distinct()
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("h"))
    left = row.join(gone, ["doc_id", "h"], "left_anti")
    again = cut(rows.where("doc_id = component_id").groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h"), "again")
    if not again.isEmpty():
        left = left.join(again, ["doc_id", "h"], "left_anti").unionByName(left.join(again, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]))
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents where doc_id is not null),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as sh from d),
e as (select doc_id, unnest(sh) as x from s),
n as (select doc_id, len(sh) as n from s),
k as (select x, list(doc_id) as ids from e group by x having count(*) > 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from e a join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 75 * (na.n + nb.n - c)),
u as (select a, b from l union select b, a from l),
r(doc_id, m) as (select doc_id, doc_id from n union select u.b, r.m from r join u on u.a = r.doc_id where r.m < u.b)
select n.doc_id, n.n::bigint as n_shingles, min(r.m)::bigint as component_id, n.doc_id = min(r.m) as kept
from n join r using (doc_id) group by n.doc_id, n.n
"""
