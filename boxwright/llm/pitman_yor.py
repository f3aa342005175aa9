"""Language-model scoring with a hierarchical Pitman-Yor model over words.

The model predicts the lower-cased words of a text and one end mark, each from the word before it. Each such context is a restaurant;
all of them share a parent, the restaurant without context, whose own base is uniform over the training words and one
unknown. Customers of a context's restaurant are the training occurrences of a word after it; customers of the parent are the tables that
serve the word in all contexts.

Seating is sampled by Gibbs sweeps: the customers of one dish leave a restaurant and come back one after another, each joining
one of the dish's k customers at t tables with weight k - d t or opening a table with weight (strength + d T) P, where T counts
all of the restaurant's tables and P is the parent's probability of the dish in the current sample. Dishes of a restaurant come one after another;
in one of more than ROUNDS dishes with several customers they come in ROUNDS groups. Past 32 customers of a dish, they come in blocks
of a thirty-second of those seated. After burn-in, predictive probabilities are averaged over the samples. A dish
with a single customer has one table in every sample.

Words get numbers, the frequent ones small: blocks of documents send their distinct words to parts that are dealt by hash, and get numbers and
training counts back. A block then keeps each document as a bag of the numbers of its distinct word pairs, and sends the pairs to
parts that are dealt by context. Such a part joins the pairs of all blocks: whole restaurants stand together, as numpy arrays in one
row. Only dishes that several customers share take part in sweeps; parts of contexts and parts of words exchange arrays of
probabilities for arrays of table counts. In the end each part answers every block's pairs in their order, and blocks add up their documents'
scores. Parts, blocks and words grow in number with the corpus and not in size; nothing is collected but a few totals, and
no order or count is cut. Probabilities that move in the end are kept to 1/5000 of a decimal logarithm.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import cut, discard, reread, table
from .words import Words, mix64, word_blocks

#: Stands for the end of a text, and before its first word.
END = 1
DISCOUNT, STRENGTH = 0.6, 1.0
BURN_IN, SAMPLES = 3, 4
#: Groups in which the dishes of a large restaurant are reseated.
ROUNDS = 32
#: Bytes of text in one block of documents, behind one part of contexts, and behind one part of words.
BLOCK, PART_TEXT, WORD_TEXT = 6 << 20, 20 << 20, 48 << 20


def tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, row) of each token; a row's words are closed by END."""
    last = np.cumsum(np.diff(w.bounds) + 1) - 1
    word = np.full(int(last[-1]) + 1 if len(last) else 0, END, np.uint64)
    word[np.arange(len(w.row)) + w.row] = w.hash  # each row before has one END
    return word, np.searchsorted(last, np.arange(len(word)))


def is_held_out(ids: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % 7 == 2 for i in ids.to_pylist()], bool)


# --- coding -----------------------------------------------------------------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """Non-negative integers, small ones in two bytes."""
    x = x.astype(np.int64)
    large = np.flatnonzero(x >= 0xFFFF)
    return np.r_[len(large)].astype("<i8").tobytes() + x[large].astype("<i8").tobytes() + np.minimum(x, 0xFFFF).astype("<u2").tobytes()


def unpacked(b: bytes) -> np.ndarray:
    n = int(np.frombuffer(b, "<i8", 1)[0])
    x = np.frombuffer(b, "<u2", offset=8 + 8 * n).astype(np.int64)
    x[x == 0xFFFF] = np.frombuffer(b, "<i8", n, 8)
    return x


def rising(x: np.ndarray) -> bytes:
    """Sorted non-negative integers by their differences."""
    return packed(np.diff(x, prepend=0))


def risen(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b))


def planes(x: np.ndarray) -> bytes:
    """Non-negative integers as planes of their bytes, so that what is alike stands together."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplaned(b: bytes) -> np.ndarray:
    width = b[0]
    n = (len(b) - 1) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8, offset=1).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.int64)


def quantised(p: np.ndarray) -> bytes:
    return np.clip(np.rint(-5000 * np.log10(np.maximum(p, 1e-13))), 0, 65535).astype("<u2").tobytes()


def logs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u2").astype(float) / -5000


# --- sampling ---------------------------------------------------------------------------------------------------------


def seat(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with c customers each who come back one by one; others: the restaurant's tables of other dishes."""
    t = np.ones(len(c))
    k = np.ones(len(c))
    live = np.flatnonzero(c > 1)
    while len(live):
        kk, tt = k[live], t[live]
        ww = (STRENGTH + d * (others[live] + tt)) * parent[live]
        m = np.minimum(np.where(kk < 32, 1, np.floor(kk / 32)), c[live] - kk)
        p = ww / (kk - d * tt + ww)
        t[live] = np.minimum(tt + rng.binomial(m.astype(np.int64), p), kk + m)
        k[live] = kk + m
        live = live[k[live] < c[live]]
    return np.where(c > 0, t, 0)


def reseat(of: np.ndarray, n: np.ndarray, t: np.ndarray, fixed: np.ndarray, parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One sweep: new tables of dishes (restaurant `of`, sorted; n customers, t tables); fixed: tables by restaurant that never change."""
    t = t.astype(float).copy()
    total = fixed + np.bincount(of, t, len(fixed))
    first = np.searchsorted(of, np.arange(len(fixed)))
    size = np.diff(np.r_[first, len(of)])
    turn = np.arange(len(of)) - first[of]
    turn = np.where(size[of] > ROUNDS, turn % ROUNDS, turn)
    order = np.argsort(turn, kind="stable")
    edges = np.searchsorted(turn[order], np.arange(int(turn.max()) + 2 if len(turn) else 1))
    for a, b in zip(edges, edges[1:]):
        at = order[a:b]
        new = seat(n[at], total[of[at]] - t[at], parent[at], DISCOUNT, rng)
        total += np.bincount(of[at], new - t[at], len(fixed))
        t[at] = new
    return t


# --- blocks and parts -------------------------------------------------------------------------------------------------

KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(), "array<binary>": pa.list_(pa.binary())}
WALKED = "kind string, block long, part int, words binary, at binary, n binary, doc_id long, held_out boolean, n_tokens long, seq binary"
NAMED = "kind string, block long, part int, at binary, ids binary, c binary, total long, known long"
BLOCKS = "kind string, block long, part int, ctx binary, size binary, dish binary, n binary, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, bag binary"
MERGED = "kind string, part int, wpart int, ranks binary, words binary, of binary, dish binary, n binary, t binary, fixed binary, blocks binary, lists array<binary>, kept array<binary>"
WORDS = "wpart int, count binary, fixed binary, c binary, t binary, kept array<binary>, customers double, tables double"
LIVE = "part int, words binary, of binary, dish binary, n binary, fixed binary, t binary, kept array<binary>"


def batch(fields: str, columns: dict[str, list]) -> pa.RecordBatch:
    """A batch of the fields; those without values are null, a single value that isn't a list is repeated."""
    size = max(len(v) for v in columns.values() if isinstance(v, (list, np.ndarray, pa.Array)))
    out, names = [], []
    for field in fields.split(", "):
        name, kind = field.split(" ")
        v = columns.get(name)
        names.append(name)
        out.append(pa.nulls(size, KINDS[kind]) if v is None else pa.array(v if isinstance(v, (list, np.ndarray)) else v if isinstance(v, pa.Array) else [v] * size, KINDS[kind]))
    return pa.RecordBatch.from_arrays(out, names=names)


def tables_of(fields: str, batches: list[dict[str, list]]) -> pa.Table:
    if not batches:
        return batch(fields, {fields.split(" ")[0]: []}).schema.empty_table()
    return pa.Table.from_batches([batch(fields, b) for b in batches])


def _walk(word_parts: int):
    """Texts -> by block: its documents as sequences of its own word numbers, and its distinct words with their numbers and training counts by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = TaskContext.get().partitionId(), 0
        for b in batches:
            for i, j, w in word_blocks(b.column(1), BLOCK):
                own = task << 32 | block
                block += 1
                ids = b.column(0).slice(i, j - i)
                held = is_held_out(ids)
                token, row = tokens(w)
                word, code, count = np.unique(token, return_inverse=True, return_counts=True)
                rank = np.empty(len(word), np.int64)
                rank[np.argsort(-count, kind="stable")] = np.arange(len(word))
                train = np.bincount(code[~held[row]], minlength=len(word))
                part = (mix64(word) % np.uint64(word_parts)).astype(np.int64)
                edge, seq = np.searchsorted(row, np.arange(j - i + 1)), rank[code]
                yield batch(WALKED, {"kind": "doc", "block": own, "doc_id": ids, "held_out": held, "n_tokens": np.diff(edge), "seq": [packed(seq[x:y]) for x, y in zip(edge, edge[1:])]})
                mine = [(p, np.flatnonzero(part == p)) for p in np.unique(part).tolist()]
                yield batch(WALKED, {"kind": "word", "block": own, "part": [p for p, _ in mine], "words": [word[x].tobytes() for _, x in mine], "at": [planes(rank[x]) for _, x in mine], "n": [packed(train[x]) for _, x in mine]})

    return run


def _number(word_parts: int):
    """A part's words of all blocks -> numbers, the frequent words first, and training counts, for each block and for the part."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        part, r = key[0].as_py(), t.to_pydict()
        lists = [np.frombuffer(x, "<u8") for x in r["words"]]
        word, back = np.unique(np.concatenate(lists), return_inverse=True)
        count = np.bincount(back, np.concatenate([unpacked(x) for x in r["n"]]), len(word)).astype(np.int64)
        order = np.lexsort((word, -count))
        rank = np.empty(len(word), np.int64)
        rank[order] = np.arange(len(word))
        edge = np.cumsum([0, *map(len, lists)])
        mine = [back[a:b] for a, b in zip(edge, edge[1:])]
        return tables_of(NAMED, [
            {"kind": ["words"], "part": part, "c": [packed(count[order])], "total": [int(count.sum())], "known": [int((count > 0).sum())]},
            {"kind": "ids", "part": part, "block": r["block"], "at": r["at"], "ids": [planes(rank[x] * word_parts + part) for x in mine], "c": [packed(count[x]) for x in mine]},
        ])

    return run


def _pairs(parts: int, n_train: int, distinct: int):
    """A block's documents and its words' numbers and counts -> documents as sorted numbers of pairs with their base scores; distinct pairs, sorted by
    part, context and word, with training counts."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return tables_of(BLOCKS, [])
        own, r = key[0].as_py(), right.to_pydict()
        at = np.concatenate([unplaned(x) for x in r["at"]])
        number, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        number[at] = np.concatenate([unplaned(x) for x in r["ids"]])
        count[at] = np.concatenate([unpacked(x) for x in r["c"]])
        seqs = [unpacked(x) for x in left.column("seq").to_pylist()]
        size = np.array([len(x) for x in seqs])
        last = np.cumsum(size) - 1
        flat, row = np.concatenate(seqs), np.repeat(np.arange(len(seqs)), size)
        held = np.array(left.column("held_out").to_pylist(), bool)
        base = np.add.reduceat(np.log10((count[flat] + 1.0) / (n_train + distinct + 1.0)), last + 1 - size)
        known = np.add.reduceat((count[flat] > 0).astype(np.int64), last + 1 - size)
        word, code = np.unique(number[flat], return_inverse=True)
        before = np.r_[code[last[0]], code[:-1]]
        before[last[:-1] + 1] = code[last[0]]  # a row's first word comes after an end
        part_of = (mix64(word.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        by_part = np.lexsort((word, part_of))
        rank = np.empty(len(word), np.int64)
        rank[by_part] = np.arange(len(word))
        pair, numbered = np.unique(rank[before] << 32 | code, return_inverse=True)
        ctx, dish = by_part[pair >> 32], pair & 0xFFFFFFFF
        train = np.bincount(numbered[~held[row]], minlength=len(pair))
        edges = np.searchsorted(part_of[ctx], np.arange(parts + 1))
        grams: dict[str, list] = {"part": [], "ctx": [], "size": [], "dish": [], "n": []}
        for p in np.flatnonzero(np.diff(edges)):
            a, b = edges[p], edges[p + 1]
            c, many = np.unique(word[ctx[a:b]], return_counts=True)
            for k, v in (("part", int(p)), ("ctx", rising(c)), ("size", packed(many)), ("dish", planes(word[dish[a:b]])), ("n", packed(train[a:b]))):
                grams[k].append(v)
        bags = [rising(np.sort(numbered[a - n + 1 : a + 1])) for a, n in zip(last, size)]
        docs = {k: left.column(k).combine_chunks() for k in ("doc_id", "held_out", "n_tokens")}
        return tables_of(BLOCKS, [{"kind": "doc", "block": own, **docs, "n_known": known, "base_score": base, "bag": bags}, {"kind": "gram", "block": own, **grams}])

    return run


def _asks(part: int, words: np.ndarray, word_parts: int, kind: str, fixed: np.ndarray | None) -> list[dict]:
    """A row for each part of words that has some of these (sorted numbers): their ranks in it."""
    out = []
    for p in np.unique(words % word_parts).tolist():
        x = np.flatnonzero(words % word_parts == p)
        out.append({"kind": [kind], "part": part, "wpart": p, "ranks": [rising(words[x] // word_parts)], "fixed": [packed(fixed[x])] if fixed is not None else None})
    return out


def _merge(word_parts: int):
    """A part's pairs of all blocks -> its distinct pairs and where each block's are among them (kind part), its dishes with several customers (live),
    and which words of which part it has (ask, live ask)."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        part, r = key[0].as_py(), t.to_pydict()
        ctxs, sizes, dishes = ([f(x) for x in r[k]] for k, f in (("ctx", risen), ("size", unpacked), ("dish", unplaned)))
        ctx, at_ctx = np.unique(np.concatenate(ctxs), return_inverse=True)
        word, at_word = np.unique(np.concatenate(dishes), return_inverse=True)
        c_off, off = np.cumsum([0, *map(len, ctxs)]), np.cumsum([0, *map(len, dishes)])
        pair = np.concatenate([np.repeat(at_ctx[c_off[i] : c_off[i + 1]], sizes[i]) for i in range(len(ctxs))]) << 32 | at_word
        pair, back = np.unique(pair, return_inverse=True)
        n = np.bincount(back, np.concatenate([unpacked(x) for x in r["n"]]), len(pair)).astype(np.int64)
        of, dish = pair >> 32, pair & 0xFFFFFFFF
        alone = np.bincount(dish, n == 1, len(word)).astype(np.int64)
        # blocks and parts both sort by number, so each block's places rise
        out = [{"kind": ["part"], "part": part, "words": [rising(word)], "of": [packed(np.bincount(of, minlength=len(ctx)))], "dish": [planes(dish)], "n": [packed(n)], "blocks": [np.array(r["block"], "<i8").tobytes()], "lists": pa.array([[rising(back[a:b]) for a, b in zip(off, off[1:])]], pa.list_(pa.binary()))}]
        out += _asks(part, word, word_parts, "ask", alone)
        live = np.flatnonzero(n > 1)
        if len(live):
            some, restaurant = np.unique(of[live], return_inverse=True)
            names, served = np.unique(dish[live], return_inverse=True)
            fixed = np.bincount(of, n == 1, len(ctx)).astype(np.int64)[some]
            out.append({"kind": ["live"], "part": part, "words": [rising(word[names])], "of": [packed(restaurant)], "dish": [packed(served)], "n": [packed(n[live])], "t": [packed(np.ones(len(live)))], "fixed": [packed(fixed)]})
            out += _asks(part, word[names], word_parts, "live ask", None)
        return tables_of(MERGED, out)

    return run


def _opened(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """A part's words before the first sweep, with the tables that never change."""
    count = unpacked(left.column("c").to_pylist()[0])
    fixed = np.zeros(len(count), np.int64)
    for ranks, n in zip(right.column("ranks").to_pylist(), right.column("fixed").to_pylist(), strict=True):
        fixed[risen(ranks)] += unpacked(n)
    none = packed(np.zeros(len(count)))
    return tables_of(WORDS, [{"wpart": [key[0].as_py()], "count": [packed(count)], "fixed": [packed(fixed)], "c": [none], "t": [none], "kept": pa.array([[]], pa.list_(pa.binary())), "customers": [0.0], "tables": [0.0]}])


def shares(c: np.ndarray, t: np.ndarray, customers: float, all_tables: float, floor: float) -> np.ndarray:
    """Probabilities of words in the restaurant without context."""
    return (c - DISCOUNT * t + (STRENGTH + DISCOUNT * all_tables) * floor) / (STRENGTH + customers)


def _told(customers: float, all_tables: float, floor: float):
    """A part of words, asked for some by parts of contexts -> the probabilities of the current sample."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = "part int, wpart int, p binary"
        if not right.num_rows:
            return tables_of(kinds, [])
        r = left.to_pylist()[0]
        p = shares(unpacked(r["c"]), unpacked(r["t"]), customers, all_tables, floor) if customers else np.full(len(unpacked(r["c"])), floor)
        return tables_of(kinds, [{"part": right.column("part").to_pylist(), "wpart": key[0].as_py(), "p": [p[risen(x)].astype("<f8").tobytes() for x in right.column("ranks").to_pylist()]}])

    return run


def in_order(words: np.ndarray, word_parts: int) -> np.ndarray:
    """Where words stand when they are taken part by part."""
    return np.lexsort((words, words % word_parts))


def _sweep(number: int, word_parts: int):
    """A part's live dishes, reseated under the parent's probabilities."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        r, told = left.to_pylist()[0], right.sort_by("wpart")
        words, of, dish, n, t, fixed = (f(r[k]) for k, f in (("words", risen), ("of", unpacked), ("dish", unpacked), ("n", unpacked), ("t", unpacked), ("fixed", unpacked)))
        p = np.empty(len(words))
        p[in_order(words, word_parts)] = np.concatenate([np.frombuffer(x, "<f8") for x in told.column("p").to_pylist()])
        new = packed(reseat(of, n.astype(float), t, fixed.astype(float), p[dish], np.random.default_rng([number, r["part"]])))
        return tables_of(LIVE, [{**{k: [r[k]] for k in ("part", "words", "of", "dish", "n", "fixed")}, "t": [new], "kept": pa.array([[*(r["kept"] or []), *([new] if number >= BURN_IN else [])]], pa.list_(pa.binary()))}])

    return run


def _served(word_parts: int):
    """Live parts -> (wpart, ranks, come): tables that serve each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.select(["words", "dish", "t"]).to_pylist():
                words = risen(r["words"])
                come = np.bincount(unpacked(r["dish"]), unpacked(r["t"]), len(words)).astype(np.int64)
                for p in np.unique(words % word_parts).tolist():
                    x = np.flatnonzero(words % word_parts == p)
                    yield batch("wpart int, ranks binary, come binary", {"wpart": [p], "ranks": [rising(words[x] // word_parts)], "come": [packed(come[x])]})

    return run


def _parent(number: int, all_tables: float, floor: float):
    """A part of words and the tables that serve them -> their tables in the restaurant without context."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        r = left.to_pylist()[0]
        c = unpacked(r["fixed"])
        for ranks, come in zip(right.column("ranks").to_pylist(), right.column("come").to_pylist(), strict=True):
            c[risen(ranks)] += unpacked(come)
        others = np.maximum(all_tables - unpacked(r["t"]), 0)
        t = seat(c.astype(float), others, np.full(len(c), floor), DISCOUNT, np.random.default_rng([number, 1, r["wpart"]]))
        return tables_of(WORDS, [{**{k: [r[k]] for k in ("wpart", "count", "fixed")}, "c": [packed(c)], "t": [packed(t)], "kept": pa.array([r["kept"]], pa.list_(pa.binary())), "customers": [float(c.sum())], "tables": [float(t.sum())]}])

    return run


def _keep(customers: float, all_tables: float, floor: float):
    """Parts of words with the probabilities of a kept sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                p = shares(unpacked(r["c"]), unpacked(r["t"]), customers, all_tables, floor)
                yield batch(WORDS, {k: [v] for k, v in r.items() if k != "kept"} | {"kept": pa.array([[*r["kept"], quantised(p)]], pa.list_(pa.binary()))})

    return run


def _all_told(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    """A part of words, asked by parts of contexts -> the probabilities of all kept samples."""
    kept = [np.frombuffer(x, "<u2") for x in left.column("kept").to_pylist()[0]]
    asked = [risen(x) for x in right.column("ranks").to_pylist()]
    return tables_of("part int, wpart int, p array<binary>", [{"part": right.column("part").to_pylist(), "wpart": key[0].as_py(), "p": pa.array([[k[x].tobytes() for k in kept] for x in asked], pa.list_(pa.binary()))}])


def _answers(word_parts: int):
    """A part with its live dishes, and its words' probabilities -> for each block, log10 probabilities of its pairs."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        r, live = next(x for x in rows if x["lists"] is not None), next((x for x in rows if x["lists"] is None), None)
        words, dish, n, size = risen(r["words"]), unplaned(r["dish"]), unpacked(r["n"]).astype(float), unpacked(r["of"])
        of, place, told = np.repeat(np.arange(len(size)), size), in_order(words, word_parts), right.sort_by("wpart").column("p").to_pylist()
        customers, mean = np.bincount(of, n, len(size)), np.zeros(len(dish))
        for s in range(SAMPLES):
            parent = np.empty(len(words))
            parent[place] = 10 ** np.concatenate([logs(x[s]) for x in told])
            t = (n > 0).astype(float)
            if live is not None:
                t[n > 1] = unpacked(live["kept"][s])
            total = np.bincount(of, t, len(size))
            mean += (n - DISCOUNT * t + (STRENGTH + DISCOUNT * total[of]) * parent[dish]) / (STRENGTH + customers[of]) / SAMPLES
        lp = np.frombuffer(quantised(mean), "<u2")
        return tables_of("block long, part int, lp binary", [{"block": np.frombuffer(r["blocks"], "<i8").astype(np.int64), "part": r["part"], "lp": [lp[risen(x)].tobytes() for x in r["lists"]]}])

    return run


def _score(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    lp = np.concatenate([logs(x) for x in right.sort_by("part").column("lp").to_pylist()])
    names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score")
    return pa.table({k: left.column(k) for k in names} | {"score": pa.array([lp[risen(x)].sum() for x in left.column("bag").to_pylist()], pa.float64())})


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) for every row with an id.

    Tokens are lower-cased words and one end. Rows whose crc32(id) mod 7 is 2 are held out, the others train. A null or empty text is
    its end alone. Without training rows, counts are 0 and scores those of the uniform base. Rows that repeat an id come out, and count in
    training, each with its own text. A text is worked on whole, in memory of some forty times its bytes. An empty table gives an empty
    one. Other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, word_parts = 1 + size // PART_TEXT, 1 + size // WORD_TEXT
    walked = cut(src.mapInArrow(_walk(word_parts), WALKED), "walked", ["kind"])
    words = walked.where("kind = 'word'").select("part", "block", "words", "at", "n")
    named = cut(words.groupBy("part").applyInArrow(_number(word_parts), NAMED), "numbers", ["kind"])
    n_train, distinct = named.where("kind = 'words'").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    floor = 1 / (distinct + 1)
    whole = walked.where("kind = 'doc'").select("block", "doc_id", "held_out", "n_tokens", "seq")
    ids = reread(named).where("kind = 'ids'").select("block", "at", "ids", "c")
    blocks = cut(whole.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_pairs(parts, n_train, distinct), BLOCKS), "blocks", ["kind"])
    discard(walked)
    discard(named, "kind=ids")
    grams = blocks.where("kind = 'gram'").select("part", "block", "ctx", "size", "dish", "n")
    merged = cut(grams.groupBy("part").applyInArrow(_merge(word_parts), MERGED), "parts", ["kind"])
    discard(blocks, "kind=gram")
    asks = lambda kind: reread(merged).where(F.col("kind") == kind).select("part", "wpart", "ranks", "fixed")
    words = named.where("kind = 'words'").select(F.col("part").alias("wpart"), "c")
    words = cut(words.groupBy("wpart").cogroup(asks("ask").groupBy("wpart")).applyInArrow(_opened, WORDS), "words")
    live = reread(merged).where("kind = 'live'").select("part", "words", "of", "dish", "n", "fixed", "t", "kept")
    customers = all_tables = 0.0
    for sweep in range(BURN_IN + SAMPLES):
        told = words.groupBy("wpart").cogroup(asks("live ask").groupBy("wpart")).applyInArrow(_told(customers, all_tables, floor), "part int, wpart int, p binary")
        new = cut(live.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_sweep(sweep, word_parts), LIVE), "live")
        discard(live)
        live = new
        come = live.mapInArrow(_served(word_parts), "wpart int, ranks binary, come binary")
        new = cut(words.groupBy("wpart").cogroup(come.groupBy("wpart")).applyInArrow(_parent(sweep, all_tables, floor), WORDS), "words")
        discard(words)
        customers, all_tables = new.agg(F.coalesce(F.sum("customers"), F.lit(0.0)), F.coalesce(F.sum("tables"), F.lit(0.0))).first()
        words = new
        if sweep >= BURN_IN:
            words = cut(new.mapInArrow(_keep(customers, all_tables, floor), WORDS), "words")
            discard(new)
    told = words.groupBy("wpart").cogroup(asks("ask").groupBy("wpart")).applyInArrow(_all_told, "part int, wpart int, p array<binary>")
    columns = ["part", "words", "of", "dish", "n", "blocks", "lists", "kept"]
    state = live.withColumns({"blocks": F.lit(None).cast("binary"), "lists": F.lit(None).cast("array<binary>")}).select(*columns)
    both = reread(merged).where("kind = 'part'").select(*columns).unionByName(state)
    answers = cut(both.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_answers(word_parts), "block long, part int, lp binary"), "answers")
    for x in (merged, named, words, live):
        discard(x)
    bags = blocks.where("kind = 'doc'").select("block", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "bag")
    out = bags.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents under a model of those that train."""
    return score_documents(table(spark, sf_dir, "documents"))
