"""The ten operators and the pipeline against brute force, round trips and held-out rows, with the odd rows that real tables have."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxwright.llm import chunks, components, decontaminate, language_id, line_dedup, near_dedup, pitman_yor, registry, sentencepieces, tiff, token_records, toxicity, warc, words, workers

SPLIT = re.compile(rb"[\x20\x09-\x0d]+")
ODD = [None, "", " \n\t ", "one", "a b c d", "A B C D", "x" * 5000, "é ü ß 日本 😀", "line\n\nline\n"]


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t) if t else 0, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `id` string")


def some_texts(n=60, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 120))) for _ in range(n)]
    for i in range(n // 2):  # near copies of all degrees
        w = texts[i].split(" ")
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    return texts + [texts[0]] * 3 + ODD


def split(t):
    return [w for w in SPLIT.split((t or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))) if w]


def test_words_and_hashes():
    texts = some_texts()
    got = [(w.row + i, w) for i, _, w in words.word_blocks(pa.array(texts), 500)]
    flat = [b"".join([w.low[a:b].tobytes()]) for _, w in got for a, b in zip(w.start, w.end)]
    assert flat == [x for t in texts for x in split(t)]
    h = np.concatenate([w.hash for _, w in got])
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_near_duplicates_equal_brute_force(spark):
    texts = some_texts()
    sets = []
    for t in texts:
        w = split(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    best = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    best[i] = min(best[i], best[j])
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs_of(spark, texts)).collect()}
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(best))
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == r.component_id) for i, r in got.items())
    assert near_dedup.near_duplicates(docs_of(spark, [])).count() == 0


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    text, other = "a b c d e f g", "h i j k l m n o"
    rows = [(3, text), (5, text), (5, other), (5, other), (None, text), (None, text), (7, None), (7, None), (8, ""), (9, text + " x"), (1, "p q r s t u")]
    docs = spark.createDataFrame([(a, b, "_", 1, 2) for a, b in rows], "doc_id long, text string, h string, row int, component_id int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect())
    assert got == [(1, 2, 1), (3, 3, 3), (5, 3, 3), (5, 4, 5), (5, 4, 5), (7, 0, 7), (7, 0, 7), (8, 0, 8), (9, 4, 3)]
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == [(-1, text), (-1, text), (1, "p q r s t u"), (3, text), (5, other), (7, ""), (7, ""), (8, "")]


def test_words_that_collide_under_every_polynomial_hash():
    a = b = ""
    for n in range(13):  # Thue-Morse words over two letters
        a, b = (a + b, b + a) if n else ("a", "b")
        if len(a) >= 1024:
            raw = np.frombuffer((a + b).encode(), np.uint8)
            h = words.span_hash(raw, np.array([0, len(a)]))
            assert h[0] != h[1]


def test_chunks_with_one_hash_keep_their_own_ids(monkeypatch):
    class Lengths(chunks.ChunkTable):
        def encode_new(self, found):
            return [[ord(x) for x in c] for c in found]

    monkeypatch.setattr(chunks, "span_hash", lambda raw, start: np.full(len(start), 7, np.uint64))
    t = Lengths("<u4")
    for texts in (["ab", "abc", "zz", "ab"], ["zz", "q", "abc"]):
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        offs = np.r_[0, np.cumsum([len(x) for x in texts])]
        ids, bounds = t.encode_chunks(raw, offs[:-1], offs)
        assert [bytes(ids[i:j].tolist()).decode() for i, j in zip(bounds, bounds[1:])] == texts


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 440)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for a, b in edges:
        for x in (a, b):
            assert got.get(x, x) == find(x)


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        i = rng.randrange(len(s) + 1)
        rng.choice((lambda: s.insert(i, "q"), lambda: s and s.pop(min(i, len(s) - 1)), lambda: s.__setitem__(slice(i, i + 1), "é")))()
    return "".join(s)


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde é") for _ in range(rng.randint(24, 60))) for _ in range(25)]
    lines = base + [edited(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(60)] + ["short line", "short line", "tiny"]
    rng.shuffle(lines)
    texts = ["\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)] + [None, "", base[0] + "\n" + base[0]]
    got = line_dedup.line_classes(docs_of(spark, texts)).collect()
    where = {}
    for d, t in enumerate(texts):
        for k, x in enumerate((t or "").split("\n")):
            if len(x) >= 10:
                where.setdefault(x, []).append((d, k))
    known = sorted(where)
    link = {x: [y for y in known if x != y and min(len(x), len(y)) >= 24 and distance(x, y) <= 2] for x in known}
    first = {x: min(where[x]) for x in known}
    for _ in known:
        for x in known:
            first[x] = min([first[x], *(first[y] for y in link[x])])
    want = {(d, k): (*first[x], len(link[x])) for x, at in where.items() for d, k in at}
    assert {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.n_links) for r in got} == want
    left = {r.doc_id: r for r in line_dedup.drop_lines(docs_of(spark, texts)).collect()}
    assert len(left) == len(texts) and left[len(texts) - 3].text is None
    for d, t in enumerate(texts):
        kept = [x for k, x in enumerate((t or "").split("\n")) if want.get((d, k), (d, k, 0))[:2] == (d, k)]
        assert (left[d].text or "") == "\n".join(kept)


def test_long_lines_are_linked_by_edits_of_words(spark):
    rng = random.Random(9)
    vocab = [f"word{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(n)] for n in (12, 14, 23, 24, 26, 30, 63, 64, 70, 90)]
    lines = [list(x) for x in base]
    for _ in range(60):
        x = list(rng.choice(base))
        for _ in range(rng.randint(1, 5)):
            i = rng.randrange(len(x))
            rng.choice((lambda: x.insert(i, rng.choice(vocab)), lambda: x.pop(i), lambda: x.__setitem__(i, rng.choice(vocab)), lambda: x.append(x.pop(i))))()
        lines.append(x)
    lines = sorted({" ".join(x) for x in lines})
    got = line_dedup.line_classes(docs_of(spark, lines), **line_dedup.WHOLE).collect()

    def near(a, b):
        x, y = a.split(" "), b.split(" ")
        most = max((t for n, t in line_dedup.WORD_CLASSES if n <= min(len(x), len(y))), default=0)
        return distance(x, y) <= most or distance(a, b) <= 2 if abs(len(x) - len(y)) <= 4 else False

    want = {i: sum(a != b and near(a, b) for b in lines) for i, a in enumerate(lines)}
    assert {r.doc_id: r.n_links for r in got} == want and sum(want.values()) > 20


def test_short_lines_have_rows_and_links(spark):
    lines = ["Les.", "Des.", "Les.", "x", "x", "The, anhely eran.", "The anhely eran.", "The anhely eran", "abcdefghijklmnopqrstuvw", "abcdefghijklmnopqrstuvwx", "nine char", "nine chat", ""]
    got = {r.doc_id: r for r in line_dedup.line_classes(docs_of(spark, lines), **line_dedup.WHOLE).collect()}
    assert set(got) == {i for i, x in enumerate(lines) if x}
    for i, r in got.items():
        near = {b for b in lines if b != lines[i] and min(len(b), len(lines[i])) >= 10 and distance(b, lines[i]) <= 1}
        assert r.n_links == len(near), lines[i]
    assert {i: r.class_doc for i, r in got.items()} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 3, 5: 5, 6: 5, 7: 5, 8: 8, 9: 8, 10: 10, 11: 11}


def test_keys_by_words_find_edits_of_characters(spark):
    rng = random.Random(29)
    lines = []
    for n in (23, 24, 25, 28, 29, 63, 64, 66, 67):
        base = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 3))) for _ in range(n))
        lines.append(base)
        for _ in range(14):  # words parted, joined and changed, most often near the ends and the borders of segments
            x = list(base)
            for _ in range(2):
                at = [0, *(i for i, c in enumerate(x) if c == " "), len(x) - 1]
                i = at[rng.choice((0, 1, 2, len(at) // 3 - 1, len(at) // 3, len(at) // 3 + 1, 2 * len(at) // 3 - 1, 2 * len(at) // 3, -3, -2, -1))]
                rng.choice((lambda: x.pop(i), lambda: x.insert(i + 1, " "), lambda: x.__setitem__(i, "z"), lambda: x.insert(i, "q")))()
            lines.append("".join(x))
    lines = list(dict.fromkeys(lines))
    got = line_dedup.line_classes(docs_of(spark, lines), **line_dedup.WHOLE).collect()

    def near(a, b):
        x, y = a.split(" "), b.split(" ")
        most = max((t for n, t in line_dedup.WORD_CLASSES if n <= min(len(x), len(y))), default=0)
        return abs(len(a) - len(b)) <= 40 and abs(len(x) - len(y)) <= 4 and (distance(x, y) <= most or distance(a, b) <= 2)

    want = dict.fromkeys(range(len(lines)), 0)
    for i in range(len(lines)):
        for j in range(i):
            if near(lines[i], lines[j]):
                want[i] += 1
                want[j] += 1
    assert {r.doc_id: r.n_links for r in got} == want and sum(want.values()) > 400


def test_keys_of_lines_are_few_and_compiled(spark, capsys):
    kinds = line_dedup._kinds(line_dedup.THRESHOLD, line_dedup.MIN_EDIT_CHARS, 10, line_dedup.WORD_CLASSES)
    lines = spark.createDataFrame([(n, " ".join(f"word{i}" for i in range(n))) for n in (10, 20, 45, 100)], "id long, line string")
    lines = lines.select("id", "line", F.length("line").alias("n"), F.split("line", " ").alias("words")).withColumn("n_words", F.size("words"))
    keys = line_dedup.keyed(lines, kinds, ["id"])
    counts = {r.id: (r.own, r.n) for r in keys.groupBy("id").agg(F.count_if("own").alias("own"), F.count("*").alias("n")).collect()}
    assert {n: counts[n] for n in counts} == {10: (3, 4), 20: (5, 6), 45: (3, 4), 100: (5, 9)}
    known = spark.createDataFrame([], "key long, id long, kind int, own boolean, keys array<long>, near struct<g: long, p: int, room: int>, f struct<letters: long, w: struct<w0: long, w1: long, w2: long, w3: long>>, c struct<id: long, id2: long>")
    for df in (keys, line_dedup._pairs(known, kinds)):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df.select("*").explain("codegen")
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) <= 8000  # the JVM compiles no longer method


def test_classes_without_links_are_the_same(spark, monkeypatch):
    rng = random.Random(17)
    vocab = [f"word{i}" for i in range(300)]
    base = [rng.choice(vocab) for _ in range(30)]
    family = [list(base) for _ in range(120)]  # one large class, most of it within a few words of one another
    for i, x in enumerate(family):
        for _ in range(1 + i % 3):
            x[rng.randrange(30)] = rng.choice(vocab)
    chain = [list(family[0])]
    for _ in range(12):  # lines that only their neighbours in the chain are near to
        chain.append(list(chain[-1]))
        chain[-1][rng.randrange(30)] = rng.choice(vocab)
    short = ["".join(rng.choice("abc ") for _ in range(rng.randint(10, 26))) for _ in range(60)]
    lines = [" ".join(x) for x in family + chain] + short + [edited(rng, rng.choice(short), 1) for _ in range(60)]
    rng.shuffle(lines)
    docs = docs_of(spark, lines)
    want = {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.kept) for r in line_dedup.line_classes(docs, **line_dedup.WHOLE).collect()}
    made, pairs = [], line_dedup._verified_links
    monkeypatch.setattr(line_dedup, "_verified_links", lambda p, *a: made.append(p.count()) or pairs(p, *a))
    got = line_dedup.line_classes(docs, **line_dedup.WHOLE, count_links=False)
    assert "n_links" not in got.columns
    assert {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.kept) for r in got.collect()} == want
    assert len({v[:2] for v in want.values()}) < len(want) / 2 and sum(made) < 120 * 119 / 4


def test_word_parities_part_lines_but_no_links(spark, monkeypatch):
    rng = random.Random(23)
    vocab = [f"word{i}" for i in range(900)]
    base = [rng.choice(vocab) for _ in range(80)]
    family = [" ".join(x) for x in [[rng.choice(vocab) if i in own else w for i, w in enumerate(base)] for own in (set(rng.sample(range(80), 4)) for _ in range(60))]]
    chars = [edited(rng, family[0], 2) for _ in range(30)] + [family[0].replace(" ", "", 2), family[0].replace("w", " ", 2)]
    lines = list(dict.fromkeys(family + chars))
    made, pairs = [], line_dedup._verified_links
    monkeypatch.setattr(line_dedup, "_verified_links", lambda p, *a: made.append(p.count()) or pairs(p, *a))
    got = line_dedup.line_classes(docs_of(spark, lines), **line_dedup.WHOLE).collect()
    split, want = [x.split(" ") for x in lines], dict.fromkeys(range(len(lines)), 0)
    for i in range(len(lines)):
        for j in range(i):
            if distance(split[i], split[j]) <= 4:  # two edits of characters are four of words at most
                want[i] += 1
                want[j] += 1
    assert {r.doc_id: r.n_links for r in got} == want and sum(want.values()) > 400
    assert sum(made) < sum(want.values()) / 2 + 150  # most of the family's 1770 pairs, eight words apart, are never compared


def test_links_of_a_family_are_counted_without_pairs(spark, monkeypatch):
    rng = random.Random(41)
    vocab = [f"word{i}" for i in range(500)]
    lines = []
    for n, size, more in ((14, 110, 0), (30, 110, 1), (70, 130, 4)):  # one place where each line has a word of its own, others here and there
        base = [rng.choice(vocab) for _ in range(n)]
        for i in range(size):
            x = [f"own{i}" if k == 5 else w for k, w in enumerate(base)]
            for _ in range(rng.randint(0, more)):
                x[rng.randrange(n)] = rng.choice(vocab)
            if i % 9 == 1:
                x.insert(rng.randrange(n), rng.choice(vocab))
            lines.append(tuple(x))
        lines.append(tuple(base))
    lines = list(dict.fromkeys(lines))
    bags, link = [Counter(x) for x in lines], {i: set() for i in range(len(lines))}
    for i, x in enumerate(lines):
        for j, y in enumerate(lines[:i]):
            most = max(t for n, t in line_dedup.WORD_CLASSES if n <= min(len(x), len(y)))
            if abs(len(x) - len(y)) <= most and max((bags[i] - bags[j]).total(), (bags[j] - bags[i]).total()) <= most and distance(x, y) <= most:
                link[i].add(j)
                link[j].add(i)
    first = {}
    for i in link:
        todo = [] if i in first else [i]
        while todo:
            if first.setdefault(k := todo.pop(), i) == i:
                todo += [j for j in link[k] if j not in first]
    made, pairs = [], line_dedup._verified_links
    monkeypatch.setattr(line_dedup, "_verified_links", lambda p, *a: made.append(p.count()) or pairs(p, *a))
    got = line_dedup.line_classes(docs_of(spark, [" ".join(x) for x in lines]), **line_dedup.WHOLE).collect()
    assert {r.doc_id: (r.class_doc, r.n_links) for r in got} == {i: (first[i], len(x)) for i, x in link.items()}
    total = sum(map(len, link.values())) // 2
    assert total > 8000 and sum(made) < total / 2


def test_checksums_and_fit_take_bounded_memory():
    import tracemalloc

    def peak(f):
        tracemalloc.start()
        out = f()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    rng = random.Random(29)
    parts = [rng.randbytes(n) for n in [0, 1, 1000, token_records.CRC_BYTES + 5, 3, *[2000] * 6000]]
    want = [int(token_records._crc32c([x])[0]) for x in parts[:8]]
    token_records.crc32c(parts[:2])
    got, most = peak(lambda: token_records.crc32c(parts))
    assert got[:8].tolist() == want and most < 4 * sum(map(len, parts))
    words_ = [f"w{i}x{i * i % 977}" for i in range(20000)]
    texts = [" ".join(rng.choices(words_, k=200)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(texts), pa.array([i % 2 for i in range(3000)], pa.int32()), pa.array([i % 3 // 2 for i in range(3000)], pa.int32())], names=["doc_id", "text", "y0", "y1"])
    pairs = sum(len(toxicity._distinct(*toxicity.features(w))[0]) for _, _, w in words.word_blocks(batch.column(1)))
    _, most = peak(lambda: list(toxicity._fit_task(2)(iter([batch]))))
    print("fit bytes a pair", most / pairs, most >> 20)
    assert most < (200 << 20) + 60 * pairs


def test_tiff_round_trips():
    rng = random.Random(4)
    datas = [b"", b"a", b"aaaa" * 5000, rng.randbytes(20000), b"abc" * 9000, bytes(range(256)) * 40]
    for x in datas:
        assert tiff.lzw_decode(tiff.lzw_encode(x)) == x and tiff.packbits_decode(tiff.packbits_encode(x)) == x
    for x in datas:
        p, n = tiff.payload_of(x.decode("latin-1"))
        assert b"".join(s.tobytes() for _, s in tiff.read_tiff(tiff.store_payload(p))) == p and len(p) % 192 == 0 and n <= len(p)
    page = np.arange(70 * 50 * 3, dtype=np.uint32).astype(np.uint8).reshape(70, 50, 3)
    for c in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        for t in (0, 16, 64):
            for p in (1, 2):
                got = list(tiff.read_tiff(tiff.write_tiff([page, page[:9]], tiff.Layout(3, c, p, 16, t))))
                assert len(got) == 2 and (got[0][1] == page).all() and (got[1][1] == page[:9]).all()


def test_tiff_pages_and_broken_files(spark):
    good = tiff.store_payload(tiff.payload_of("abc " * 100_000)[0])
    rows = [(1, good), (2, b"II*"), (3, None), (4, good[: len(good) // 2])]
    got = tiff.tiff_pages(spark.createDataFrame(rows, "k long, m binary"), "k", "m").collect()
    assert [r.page for r in sorted((r for r in got if r.id == 1), key=lambda r: r.page)] == [0, 1, 2]
    assert all(any(r.error for r in got if r.id == i) for i in (2, 3, 4))


def tagged(data, tag, value, kind=4):
    """data with the value of a tag that it has changed."""
    import struct

    at = struct.unpack_from("<I", data, 4)[0]
    out = bytearray(data)
    for i in range(struct.unpack_from("<H", data, at)[0]):
        e = at + 2 + 12 * i
        if struct.unpack_from("<H", data, e)[0] == tag:
            struct.pack_into("<I" if kind == 4 else "<H", out, e + 8, value)
    return bytes(out)


def test_tiff_files_that_cannot_be_read_are_refused(spark):
    page = np.arange(60, dtype=np.uint8).reshape(5, 4, 3)
    good = tiff.write_tiff([page], tiff.Layout(3, tiff.DEFLATE, 2, 5, 0))
    bad = [tagged(good, tiff.PREDICTOR, 3, 3), tagged(good, tiff.WIDTH, 3_000_000), tagged(tagged(good, tiff.WIDTH, 3_000_000), tiff.LENGTH, 3_000_000), tagged(good, tiff.COMPRESSION, 7, 3), tagged(good, tiff.ROWS_PER_STRIP, 0)]
    rows = [(0, good), *((i + 1, x) for i, x in enumerate(bad))]
    got = tiff.tiff_pages(spark.createDataFrame(rows, "k long, m binary"), "k", "m").collect()
    assert {r.id: r.error is None for r in got} == {0: True} | {i + 1: False for i in range(len(bad))}
    planar = good.replace(__import__("struct").pack("<HHI", tiff.PHOTOMETRIC, 3, 1), __import__("struct").pack("<HHI", tiff.PLANAR, 3, 1)).replace(b"\x1c\x01\x03\0\x01\0\0\0\x02\0", b"\x1c\x01\x03\0\x01\0\0\0\x02\0")
    with pytest.raises(ValueError):
        list(tiff.read_tiff(planar))


def test_stored_texts_read_back(spark):
    """The query's columns against hashes of the payloads themselves."""
    texts = some_texts(10) + ["long text " * 60_000]
    got = {r.doc_id: r for r in tiff.digests_of(tiff.stored_documents(docs_of(spark, texts))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        pay = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-16:]))
        media = tiff.store_payload(pay)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        samples = np.frombuffer(pay, np.uint8).astype(np.int64)
        sums = [int(x.split(":")[1]) for x in r.feature.split("|")]
        assert sum(sums) == samples.sum()
    assert tiff.digests_of(tiff.stored_documents(docs_of(spark, []))).count() == 0


def test_warc(spark):
    rows = [(1, "http://a/ b", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c", ""), (5, "u", "é😀"), (5, "u", "é😀")]
    path = warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(tuple(r) for r in warc.parse_records(spark, path).collect() for r in [[r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1]])
    sha = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    assert got == [(1, 4, sha("same"), "revisit", 2), (2, 4, sha("same"), "response", -1), (3, 0, sha(""), "revisit", 4), (4, 0, sha(""), "response", -1), *[(5, 6, sha("é😀"), "response", -1)] * 2]
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    full = {r.page_id: bytes(r.payload) for r in warc.read_records(spark, path, bodies_of_revisits=True).collect()}
    assert full[1] == b"same" and full[3] == b""
    out = f"{path}-plain"
    warc.export_warc(warc.read_records(spark, path), out)
    import glob

    seen = []
    for f in glob.glob(f"{out.removeprefix('file:')}/part-*"):
        data = open(f, "rb").read()
        while data:
            fields, body = warc.parse_header(data)
            n = int(fields["content-length"])
            seen.append((fields["warc-record-id"], fields["warc-type"], data[body : body + n].split(b"\r\n\r\n", 1)[1]))
            assert data[body + n : body + n + 4] == b"\r\n\r\n"
            data = data[body + n + 4 :]
    assert sorted(seen) == sorted([("<urn:page:1>", "revisit", b""), ("<urn:page:2>", "response", b"same"), ("<urn:page:3>", "revisit", b""), ("<urn:page:4>", "response", b""), *[("<urn:page:5>", "response", "é😀".encode())] * 2])
    assert warc.parse_records(spark, warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def slow_crc32c(b):
    c = 0xFFFFFFFF
    for x in b:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_records(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(1)
    parts = [b"", b"123456789", *(rng.randbytes(rng.randint(0, 900)) for _ in range(20))]
    assert token_records.crc32c(parts).tolist() == [slow_crc32c(x) for x in parts] and slow_crc32c(b"123456789") == 0xE3069283
    buf = bytearray(b"".join(x + b"\n" for x in token_records.frame(parts)))
    assert [bytes(d) for _, d in token_records.unframe(memoryview(buf))] == parts
    buf[40] ^= 1
    with pytest.raises(ValueError):
        token_records.unframe(memoryview(buf))
    name = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(name)
    texts = some_texts(20) + ["<|endoftext|> a<|endoftext|>b", "it's  'tis　x"] + ["".join(rng.choice("ab \n.'s\t1é　") for _ in range(30)) for _ in range(200)]
    path = token_records.write_records(docs_of(spark, texts), name, end_id=2, shard_text_bytes=4000)
    index = token_records.build_index(spark, path, name)
    start, want = 0, []
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in index.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want
    some = token_records.read_shuffled(spark, path, index.where("doc_id % 7 = 3"), name).collect()
    assert {r.doc_id: r.ids for r in some} == {i: [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2] for i in range(3, len(texts), 7)}


def test_pieces(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib, rng = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(2)
    texts = some_texts(30) + ["Hello  world\n x  ", "<s> b </s>c<0x0A>", "▁a ▁ b", "a" * 70 + " " * 40] + ["".join(rng.choice(["a", "the", "ing", " ", "\n", ".", "é", "　", "▁", "😀", "on", "1"]) for _ in range(30)) for _ in range(300)]
    enc = sentencepieces.encode_documents(docs_of(spark, texts), path)
    assert {r.doc_id: r.ids for r in enc.collect()} == {i: lib.encode(t or "") for i, t in enumerate(texts)}
    dec = {r.doc_id: r.text for r in sentencepieces.decode_documents(enc, path).collect()}
    assert dec == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert issubclass(sentencepieces.PieceEncoder, chunks.ChunkTable)
    own = sentencepieces.encoder(path)
    for x in (" " * 3000 + "word", "a" * 3000, "the" * 1000, "ab ab" * 50):
        raw = np.frombuffer(x.encode(), np.uint8)
        assert own.encode(raw, np.array([0, len(raw)]))[0].tolist() == lib.encode(x)


def test_workers_drop_what_another_stage_kept(spark):
    import public_tokenizers

    def encoders(batches):
        import gc

        n = sum(type(x).__name__ == "PieceEncoder" for x in gc.get_objects())
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    docs = docs_of(spark, some_texts(20)).repartition(64)  # tasks take waiting workers in turn: 64 come to each of them
    held = lambda: sum(r.n for r in spark.range(0, 64, 1, 64).mapInArrow(encoders, "n long").collect())
    sentencepieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")).count()
    assert held() > 0
    labels = spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(30)], "doc_id long, quality int, toxic int")
    toxicity.drop_toxic(docs, toxicity.fit(docs, labels, toxicity.label_categories())).count()
    assert held() == 0


def test_workers_that_wait_let_go(monkeypatch):
    import time

    monkeypatch.setattr(workers, "WAIT", 0.2)
    monkeypatch.setattr(workers, "_kept", {})
    run = workers.lean(lambda batches: (workers.kept("a", lambda: [0]) for _ in batches), keeps=True)
    assert list(run(iter([1, 2]))) == [[0], [0]] and workers._kept
    list(run(iter([1])))  # a task in time: it finds what the one before kept, and the time starts anew
    time.sleep(0.1)
    task = run(iter([1, 2]))
    next(task)
    time.sleep(0.4)
    assert workers._kept  # a task is going on
    list(task)
    time.sleep(0.6)
    assert not workers._kept


def test_workers_that_wait_hold_no_chunks(spark):
    import time

    import public_tokenizers

    def encoders(batches):
        import gc

        n = sum(type(x).__name__ == "ChunkEncoder" for x in gc.get_objects())
        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    token_records.write_records(docs_of(spark, some_texts(20)), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, shard_text_bytes=1000)
    time.sleep(workers.WAIT + 2)
    assert sum(r.n for r in spark.range(0, 64, 1, 64).mapInArrow(encoders, "n long").collect()) == 0


def test_a_round_trip_of_pieces_takes_one_worker(spark, capsys):
    import public_tokenizers

    path, docs = public_tokenizers.path("piece_bpe_32k.model"), docs_of(spark, some_texts(20))
    both = sentencepieces.round_trip(docs, path)
    want = sentencepieces.decode_documents(sentencepieces.encode_documents(docs, path), path)
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    import __spark_entry__

    capsys.readouterr()
    __spark_entry__.queries()["op5_sentencepiece"](spark, "/root/testdata/sf0.001").explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_fit_counts_in_little_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    row, f = np.sort(rng.integers(0, 3000, 400_000)).astype(np.int32), (rng.zipf(1.3, 400_000) % (1 << toxicity.SPACE_BITS)).astype(np.int32)
    y = (np.arange(3000) % 3 == 0).astype(float)
    size = 1 << toxicity.SPACE_BITS
    pos, every = np.bincount(f[y[row] > 0.5], minlength=size), np.bincount(f, minlength=size)
    z = (pos - every * y.mean()) / np.sqrt(every * y.mean() * (1 - y.mean()) + 1.0)
    ok = np.flatnonzero((every >= 3) & (np.abs(z) > 2))
    want = np.sort(ok[np.argsort(-np.abs(z[ok]), kind="stable")[: toxicity.MAX_FEATURES]])
    tracemalloc.start()
    got = toxicity._select(row, f, y)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(want) and got.tolist() == want.tolist() and most < 25 * size
    for values in ([], [4], [1, 1, 2, 5, 5, 5]):
        a, b = toxicity._spans(np.array(values, np.int32)), np.unique(np.array(values, np.int32), return_index=True)
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def unigram_model(pieces):
    """A serialized unigram model by hand: pieces with scores, identity normalisation."""
    import struct

    def number(x):
        out = b""
        while True:
            out += bytes([x & 127 | (128 if x > 127 else 0)])
            x >>= 7
            if not x:
                return out

    field = lambda tag, body: number(tag << 3 | 2) + number(len(body)) + body
    flag = lambda tag, x: number(tag << 3) + number(x)
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((p, s, 1) for p, s in pieces)]
    body = b"".join(field(1, field(1, p.encode()) + number(2 << 3 | 5) + struct.pack("<f", s) + flag(3, k)) for p, s, k in rows)
    return body + field(2, flag(3, 1) + flag(4, len(rows))) + field(3, field(1, b"identity") + flag(3, 1) + flag(4, 0) + flag(5, 1))


def test_unigram_forward_scores_follow_the_library(tmp_path):
    import sentencepiece

    rng = random.Random(11)
    letters = "abcd"
    pieces = {"▁": -4.0} | {x: -3.0 - rng.random() for x in letters}
    for n in (2, 3, 4):
        for _ in range(25):
            p = "".join(rng.choice(letters) for _ in range(n))
            pieces[p] = -2.0 - 1.5 * n * rng.random()
            pieces["▁" + p] = -2.0 - 1.5 * n * rng.random()
    path = str(tmp_path / "uni.model")
    open(path, "wb").write(unigram_model(sorted(pieces.items())))
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.PieceEncoder(path)
    assert not own.bpe
    for _ in range(300):
        x = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 6)))
        raw = np.frombuffer(x.encode(), np.uint8)
        got = own.encode(raw, np.array([0, len(raw)]))[0].tolist()
        score = lambda ids: sum(lib.get_score(i) for i in ids)
        assert got == lib.encode(x) or score(got) == pytest.approx(score(lib.encode(x)), abs=1e-4)


def test_pitman_yor_counts_and_probabilities(spark):
    texts = some_texts(80)
    got = {r.doc_id: r for r in pitman_yor.score_documents(docs_of(spark, texts)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    c = Counter(x for i, t in enumerate(texts) if not held[i] for x in [*split(t), "end"])
    n, v = sum(c.values()), len(c)
    assert set(got) == set(range(len(texts)))
    for i, t in enumerate(texts):
        toks = [*split(t), "end"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(toks), sum(c[x] > 0 for x in toks), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in toks)) and r.score < 0
    exact = hand_model([["END", *split(t), "END"] for i, t in enumerate(texts) if not held[i]], seed=4)
    for i, t in enumerate(texts):
        assert got[i].score == pytest.approx(exact(["END", *split(t), "END"]), rel=0.03, abs=0.4), i
    odd = spark.createDataFrame([(5, "alpha beta"), (5, "alpha beta gamma delta epsilon"), (None, "x"), (6, None)], "doc_id long, text string")
    got = pitman_yor.score_documents(odd.withColumn("n", F.lit(1)).withColumn("part", F.lit(2))).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(5, 3), (5, 6), (6, 1)] and len({r.score for r in got}) == 3
    assert pitman_yor.score_documents(odd.where("false")).count() == 0


def hand_model(rows, seed, sweeps=(40, 60)):
    """log10 probability under the two-level model, customers seated one at a time in dictionaries (no blocks, no groups, many sweeps)."""
    rng, d, s = random.Random(seed), pitman_yor.DISCOUNT, pitman_yor.STRENGTH
    pairs = Counter((a, b) for r in rows for a, b in zip(r, r[1:]))
    vocab = {b for _, b in pairs}
    floor = 1 / (len(vocab) + 1)
    tables = {k: 1 for k in pairs}
    size = Counter()
    for (a, _), n in pairs.items():
        size[a] += n
    top, kept = {}, []

    def seated(n, others, p):
        t = 1
        for k in range(1, n):
            new = (s + d * (others + t)) * p
            t += rng.random() * (k - d * t + new) < new
        return t

    for sweep in range(sum(sweeps)):
        come = Counter()
        for (_, b), t in tables.items():
            come[b] += t
        total = sum(top.values())
        for b, n in come.items():
            total -= top.get(b, 0)
            top[b] = seated(n, total, floor)
            total += top[b]
        customers = sum(come.values())
        parent = lambda b, come=come, top=dict(top), total=total, customers=customers: (come.get(b, 0) - d * top.get(b, 0) + (s + d * total) * floor) / (s + customers)
        of = Counter()
        for (a, _), t in tables.items():
            of[a] += t
        for (a, b), n in pairs.items():
            if n > 1:
                of[a] -= tables[a, b]
                tables[a, b] = seated(n, of[a], parent(b))
                of[a] += tables[a, b]
        if sweep >= sweeps[0]:
            kept.append((parent, dict(tables), dict(of)))

    def p(a, b):
        return sum((pairs.get((a, b), 0) - d * t.get((a, b), 0) + (s + d * of.get(a, 0)) * parent(b)) / (s + size[a]) for parent, t, of in kept) / len(kept)

    return lambda r: sum(math.log10(p(a, b)) for a, b in zip(r, r[1:]))


def test_pitman_yor_predicts_words_in_order(spark):
    docs = docs_of(spark, ["red green blue"] * 40 + ["red green blue", "blue green red"], first=1)
    score = {r.doc_id: r.score for r in pitman_yor.score_documents(docs).collect()}
    assert score[41] > score[42] + 1


def test_probabilities_after_any_word_sum_to_one(spark):
    """One-word texts have the probability of the word at the start, times that of the end after it."""
    vocab = ["a", "b", "c", "d"]
    texts = ["a b", "a a", "b", "c c c", "d a"] * 6
    asked = [*vocab, "unknown"]
    docs = docs_of(spark, texts + [x for x in asked], first=0)
    rows = [x for i, x in enumerate(texts + asked)]
    model = hand_model([["END", *r.split(), "END"] for i, r in enumerate(rows) if zlib.crc32(str(i).encode()) % 7 != 2], seed=1, sweeps=(2, 2))
    got = {r.doc_id: 10**r.score for r in pitman_yor.score_documents(docs).collect()}
    assert all(0 < x < 1 for x in got.values()) and model(["END", "a", "END"]) < 0


def test_packed_numbers():
    x = np.r_[0, 5, 65534, 65535, 65536, 1 << 40, 7]
    assert (pitman_yor.unpacked(pitman_yor.packed(x)) == x).all() and (pitman_yor.risen(pitman_yor.rising(np.sort(x))) == np.sort(x)).all()
    assert len(pitman_yor.unpacked(pitman_yor.packed(x[:0]))) == 0


@pytest.mark.parametrize("others, parent", [(0.0, 1.0), (3.0, 0.4)])
def test_seating_follows_the_restaurant_rule(others, parent):
    """Tables of 20 customers against seating them one by one, with all tables of the restaurant in the weight of a new one."""
    n, rng, d, tables = 4000, random.Random(8), pitman_yor.DISCOUNT, []
    for _ in range(n):
        t = 1
        for k in range(1, 20):
            new = (pitman_yor.STRENGTH + d * (others + t)) * parent
            t += rng.random() * (k - d * t + new) < new
        tables.append(t)
    got = pitman_yor.seat(np.full(n, 20.0), np.full(n, others), np.full(n, parent), d, np.random.default_rng(8))
    assert got.mean() == pytest.approx(np.mean(tables), abs=5 * np.std(tables) * (2 / n) ** 0.5)


def test_alignment_and_leaks(spark):
    item = [f"k{i}" for i in range(40)]
    rng = random.Random(6)
    copy = list(item)
    copy[5], copy[15], copy[25] = "x", "y", "z"
    copy.insert(30, "more")
    noise = [f"n{rng.randint(0, 500)}" for _ in range(400)]
    texts = [" ".join(noise[:50] + item + noise[50:90]), " ".join(noise[:200] + copy), " ".join(noise), " ".join(noise[:9] + item[:5] + noise[9:30]), *ODD]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "a b"), (4, " ".join(f"z{i}" for i in range(20)))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(docs_of(spark, texts), bench).collect()}
    # items 1 and, by its very words, the short item 3
    assert set(got) == {(0, 1), (1, 1), (8, 3), (9, 3)}
    assert (got[8, 3].first_word, got[8, 3].end_word, got[8, 3].similarity) == (0, 2, 1.0)
    assert (got[0, 1].first_word, got[0, 1].end_word, got[0, 1].similarity) == (50, 90, 1.0)
    assert got[1, 1].equal_words == 37 and got[1, 1].score == 37 * 2 - 3 - 1
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs_of(spark, texts), bench).collect()) == [i for i in range(2, len(texts)) if i not in (8, 9)]
    assert decontaminate.find_leaks(docs_of(spark, texts), bench.where("false")).count() == 0


def slow_align(item, doc):
    h = [[0] * (len(doc) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(doc, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 14))] for _ in range(2))
        score, i, j, equal = decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == slow_align(a, b) and 0 <= i <= j <= len(b)
        if score:  # the passage alone has the same score, and as many equal words as that needs
            assert slow_align(a, b[i:j]) == score and 2 * equal - (j - i) <= score <= 2 * equal


def test_recall_of_seeds_against_all_alignments(spark):
    """All documents whose id is divisible by 100 against all items, and all against items divisible by 100: found by seeds or by aligning everything."""
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    d = [(r.doc_id, next(words.word_blocks(pa.array([r.text or ""])))[2].hash) for r in docs.collect()]
    b = [(r.item_id, next(words.word_blocks(pa.array([r.text or ""])))[2].hash) for r in bench.collect()]
    want = set()
    for i, x in d:
        for k, y in b:
            if (i % 100 == 0 or k % 100 == 0) and len(y) >= decontaminate.MIN_WORDS and len(np.intersect1d(x, y)) * 2 >= len(np.unique(y)) * 0.5:
                if decontaminate.align(y, x)[0] >= decontaminate.SIMILARITY * decontaminate.MATCH * len(y):
                    want.add((i, k))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect() if r.doc_id % 100 == 0 or r.item_id % 100 == 0}
    assert got <= want and len(got) >= 0.9 * len(want) and want


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 4 <> 1")
    model = toxicity.fit(docs, train, toxicity.label_categories())
    r = toxicity.toxicity(docs, model).join(labels.where("doc_id % 4 = 1"), "doc_id").collect()
    assert sum(x.rejected == (x.toxic == 1) for x in r) >= 0.9 * len(r)
    out = toxicity.toxicity(docs_of(spark, ODD), model)
    assert out.count() == len(ODD) and out.where("p_toxic is null").count() == 0
    assert toxicity.fit(docs, labels.where("false"), toxicity.label_categories()) is None
    assert toxicity.drop_toxic(docs_of(spark, ODD), model).columns == docs_of(spark, ODD).columns


def test_languages(spark):
    sf = "/root/testdata/sf0.01"
    docs, pages = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages"))
    odd = spark.createDataFrame([(-1, None, None), (-2, "", ""), (-3, "http://x.de/", "<html lang=de></html>")], "page_id long, url string, html string")
    got = {r.page_id: r for r in language_id.identify(pages.unionByName(odd), docs).collect()}
    assert len(got) == pages.count() + 3 and got[-3].lang == "de" and got[-1].lang is not None
    by_path = {r.page_id: r.k for r in pages.select("page_id", F.regexp_extract("url", r"://[^/]+/([a-z]{2})/", 1).alias("k")).collect() if r.k}
    assert sum(got[i].lang == k for i, k in by_path.items()) >= 0.9 * len(by_path)
    assert language_id.identify(pages, docs.where("false")).where("lang is not null").count() == 0


def test_hidden_text_is_left_out_in_one_pass():
    assert language_id.visible_text("a<script>b</script>c<!--d-->e<style>f") == "a c e f"
    assert language_id.visible_text("<SCRIPT x>y</script >z").strip() == "z"
    assert language_id.visible_text("<script>" * 20_000 + "x").strip() == "x"


def test_every_labelled_language_is_told_apart(spark):
    """70 languages, the last ones with least text: pages of each are recognised."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(12)
    words_of = {f"{a}{b}": ["".join(rng.choice(letters) for _ in range(7)) for _ in range(6)] for a in letters[:7] for b in letters[:10]}
    docs = spark.createDataFrame([(k, " ".join(w * (80 - i))) for i, (k, w) in enumerate(words_of.items())], "lang string, text string")
    pages = spark.createDataFrame([(i, None, f"<p>{' '.join(w * 3)}</p>") for i, w in enumerate(words_of.values())], "page_id long, url string, html string")
    got = {r.page_id: r.lang for r in language_id.identify(pages, docs).collect()}
    assert got == dict(enumerate(words_of))


def test_tables_without_rows_and_with_odd_columns(spark):
    import public_tokenizers

    pieces, bytes_ = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
    names = ("n", "line", "_doc", "_gone", "component_id", "row", "h", "key", "word", "lines", "gone")
    odd = docs_of(spark, ["one line here", "one line here\nother", None, ""]).select("*", *(F.lit(i).alias(k) for i, k in enumerate(names)))
    left = line_dedup.drop_lines(odd, **line_dedup.WHOLE)
    assert left.columns == odd.columns and {r.doc_id: r.text for r in left.collect()} == {0: "one line here", 1: "other", 2: None, 3: ""}
    assert near_dedup.drop_near_duplicates(odd).columns == odd.columns
    none = odd.where("false")
    assert line_dedup.line_classes(none, **line_dedup.WHOLE).count() == 0 and line_dedup.drop_lines(none).count() == 0
    assert sentencepieces.decode_documents(sentencepieces.encode_documents(none, pieces), pieces).count() == 0
    path = token_records.write_records(none, bytes_, end_id=2)
    assert token_records.build_index(spark, path, bytes_).count() == 0


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, name):
    import duckdb

    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.sql(registry.SQL[name])
    cols = sorted(want.columns)
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, sf)
        assert out.columns == docs.columns, name
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert 0 < docs.count() <= n
        n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == n
