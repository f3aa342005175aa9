"""Hand-made edge cases."""

import json
import tarfile

import pytest
from pyspark.sql import functions as F

from boxwright.functions import geom, text as tx
from boxwright.operators import align, filters, joins, policies, records
from boxwright.sources import assets, jsonl


def test_boxes_at_the_edges(spark):
    rows = [(1, [10.0, 10.0, 0.0, 0.0]), (2, [-5.0, 0.0, 50.0, 500.0]), (3, [1.0, 1.0, 1.0, 9.0]), (4, [1.0, 2.0, 3.0]), (5, None), (6, [1.0, None, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "id int, b array<double>").select("id", geom.fix_and_clip(F.col("b"), F.lit(100), F.lit(200)).alias("c"))
    got = {r[0]: r[1] for r in df.collect()}
    assert got == {1: [0, 0, 10, 10], 2: [0, 0, 50, 200], 3: [1, 1, 1, 9], 4: None, 5: None, 6: None}


def test_agreement_rules(spark):
    b = [0.0, 0.0, 10.0, 10.0]
    rows = [(1, 1, [b, b]), (2, 1, [b, [50.0, 50.0, 60.0, 60.0]]), (3, 2, [b]), (4, 3, []), (5, None, None), (6, 4, [[1.0], [2.0]])]
    df = spark.createDataFrame(rows, "row_id int, image int, bboxs array<array<double>>")
    got = {r.row_id: (r._route, r._reason) for r in filters.box_agreement(df).collect()}
    assert got[1] == ("ok", None) and got[3] == ("ok", None)
    assert got[2] == ("bad", "mean_pairwise_iou<0.9")
    assert got[4][1] == got[5][1] == "missing_or_empty_bboxs" and got[6][1] == "invalid_bboxs_after_parsing"
    image = {r.row_id: r._route for r in filters.box_agreement_by_image(df).collect()}
    assert image == {1: "bad", 2: "bad", 3: "ok", 4: "bad", 5: "bad", 6: "bad"}


def test_validity_reasons(spark):
    items = ['{"bbox": [1, 2, 3, 4]}', '{"bbox": ["3", 1, 2, true]}', '{"bbox": [1, 2, 3]}', '{"bbox": ["x", 1, 2, 3]}', '{"bbox": {"ymin": 1, "xmin": 2}}', "[1, 2, 3, 4]", '{"bbox": "a"}']
    rows = [(i, f"[{x}]") for i, x in enumerate(items)] + [(10, "[]"), (11, "{}"), (12, None), (13, "bad")]
    got = {r[0]: r[1] for r in filters.box_validity(spark.createDataFrame(rows, "id int, bboxes string")).select("id", "_reasons").collect()}
    assert got[0] == got[1] == got[10] == []
    assert [got[i][0] for i in range(2, 7)] == ["bbox_list_len!=4", "bbox_list_non_numeric", "bbox_dict_missing_keys", "bbox_item_not_dict", "bbox_wrong_type"]
    assert got[11] == got[12] == got[13] == ["bboxes_not_a_list_or_missing"]


def test_names(spark):
    df = spark.createDataFrame([("d/--a.mp4",), ("-----a.mp4",), ("a.",), (".b",), ("x/y.tar.gz",)], "p string")
    got = [tuple(r) for r in df.select(tx.norm_filename(F.col("p")), tx.stem(F.col("p"))).collect()]
    assert got == [("a.mp4", "--a"), ("-a.mp4", "-----a"), ("a.", "a."), (".b", ".b"), ("y.tar.gz", "y.tar")]


def test_model_replies(spark):
    rows = [('```json\n{"a": 1}\n```',), ('so: {"a": 1} ok',), ("[1]",), ("",), (None,), ('{"a": 1}',)]
    got = [r[0] for r in spark.createDataFrame(rows, "r string").select(tx.json_object_in(F.col("r"))).collect()]
    assert [json.loads(x) if x else None for x in got] == [{"a": 1}, {"a": 1}, None, None, None, {"a": 1}]


def test_one_failed_annotation_fails_its_key(spark):
    base = spark.createDataFrame([("a ",), ("b",), ("c",), ("c",)], "k string")
    done = spark.createDataFrame([("a", False, 1), ("b", True, 1), ("b", False, 2)], "k string, failed boolean, at int")
    assert sorted((r.k, r._why) for r in joins.todo_rows(base, done, ["k"]).collect()) == [("b", "failed"), ("c", "missing"), ("c", "missing")]
    assert sorted(r.k for r in joins.todo_rows(base, done, ["k"], latest_wins="at").collect()) == ["c", "c"]


def words(text, doc="d"):
    return [(doc, i, w, [10.0 * (i // 8), 100.0 * (i % 8), 10.0 * (i // 8) + 8, 100.0 * (i % 8) + 90], i // 8) for i, w in enumerate(text.split())]


def test_a_verbatim_passage_is_found(spark):
    text = " ".join(f"word{i}" for i in range(40)) + " Total amount 1,250.00 due"
    w = spark.createDataFrame(words(text), "doc_id string, word_idx int, text string, bbox array<double>, line_idx int")
    rows = spark.createDataFrame([("d", 1, 0, ["total amount 1,250.00"], None), ("d", 2, 0, ["—"], None), ("e", 3, 0, ["x"], None), ("d", 4, 0, [], None)], "doc_id string, row_id int, box_no int, labels array<string>, pred_box array<double>")
    got = {r.row_id: r for r in align.match_labels(rows, w).collect()}
    assert got[1].m.ok and got[1].m.coverage == 1 and got[1].m.char_ratio == 1 and got[1].m.words == [40, 41, 42]
    assert not got[2].m.ok and got[2].m.reason == "no_anchor_hits" and got[3].m is None and got[4].m is None


def test_retries_and_merge(spark):
    df = spark.createDataFrame([(1, "p1", [[0.0, 0.0, 1.0, 1.0]]), (2, "boom", [[0.0, 0.0, 2.0, 2.0]])], "row_id long, t string, seed_boxes array<array<double>>")

    def annotator(s):
        if s == "boom":
            raise ValueError("no")
        return '{"answer_type": "extractive", "bboxes": [{"bbox": [1, 2, 3, 4]}, {"bbox": [1]}]}'

    r = records.annotate(df, "row_id", "t", annotator, max_retries=1, base_sleep=0.0)
    got = {x.row_id: x for x in records.merge_replies(df, r, "row_id").collect()}
    assert got[1]._route == "ok" and [b.bbox for b in got[1].bboxes] == [[1, 2, 3, 4]] and got[1].bboxes[0].role == "context"
    assert got[2]._route == "bad" and got[2].bboxes[0].bbox == [0, 0, 2, 2]


def test_jsonl(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n  \nbad\n[1]\n{"b": "é"}\n', encoding="utf-8")
    got = [(r.line_no, r.parse_error) for r in jsonl.scan(spark, str(p)).orderBy("line_no").collect()]
    assert got == [(1, None), (4, "bad_json"), (5, "not_an_object"), (6, None)]
    assert jsonl.scan(spark, str(p), on_bad="skip").count() == 2
    x = spark.createDataFrame([('{"b": "é", "a": 1}', '{"a": 2, "c": null}')], "raw string, patch string")
    assert x.select(jsonl.patched("raw", "patch")).first()[0] == '{"b": "é", "a": 2, "c": null}'
    assert jsonl.pick_columns(["Question_ID", "ANSWER"], {"qid": ["question id"], "answer": ["answer"], "x": ["y"]}) == {"qid": "Question_ID", "answer": "ANSWER"}


def test_split_tar(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.txt", "b.txt"):
        (tmp_path / "in" / name).write_text(name * 1000)
    whole = tmp_path / "w.tar"
    with tarfile.open(whole, "w") as t:
        t.add(tmp_path / "in" / "a.txt", "top/" + "x" * 120 + "/a.txt")
        t.add(tmp_path / "in" / "b.txt", "top/b.txt")
        t.add(tmp_path / "in" / "b.txt", "top/../../evil.txt")
    data = whole.read_bytes()
    parts = [tmp_path / "p.tar.00", tmp_path / "p.tar.01"]
    parts[0].write_bytes(data[:3000])
    parts[1].write_bytes(data[3000:])
    out = tmp_path / "out"
    did = {r.path: r.did for r in assets.extract_tar(spark, [str(p) for p in parts], str(out), strip=1).collect()}
    assert sorted(did.values()) == ["refused", "written", "written"]
    assert (out / "b.txt").read_text() == "b.txt" * 1000 and not (tmp_path / "evil.txt").exists()
    again = assets.extract_tar(spark, [str(p) for p in parts], str(out), strip=1).collect()
    assert sorted(r.did for r in again) == ["kept", "kept", "refused"]


def test_streamed_todo(spark, tmp_path):
    from boxwright.streaming import todo

    spark.createDataFrame([(1, "a"), (2, "b")], "k long, t string").write.parquet(str(tmp_path / "in"))
    q = todo.start(spark, str(tmp_path / "in"), "k long, t string", str(tmp_path / "done"), str(tmp_path / "cp"), "k", "t")
    q.awaitTermination(60)
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "done")).collect()) == [1, 2]


@pytest.mark.parametrize("name, split", [("train-00000-of-00002.parquet", "train"), ("validation-00000-of-00001.parquet", "val"), ("dev-x.parquet", "val"), ("x.parquet", None)])
def test_splits(name, split):
    assert assets.split_of(name) == split


def slow_match(label, pred, words):
    """The matcher as it is described, in plain loops: (reason without figures, coverage, words)."""
    import difflib

    toks = align.norm(label).split()
    toks = [t for t in toks if t not in tx.STOPWORDS] or toks
    if not toks:
        return "empty_label_tokens", 0.0, []
    flat = [(t, i) for i, (text, _, _) in enumerate(words) for t in align.norm(text).split()]
    skel, num = align.skeleton, align.number
    has = lambda t: any(c in "0123456789" for c in t)
    same = lambda a, b: (has(a) and has(b) and num(a) == num(b)) or skel(a) == skel(b)
    value = lambda t: 10.0 * has(t) + min(len(skel(t)), 12) / 6
    anchors = sorted((t for t in toks if t not in tx.STOPWORDS and skel(t)), key=lambda t: -value(t))[:5]
    places = sorted({p for p, (t, _) in enumerate(flat) if any(skel(t) == skel(a) for a in anchors)})
    if not places:
        return "no_anchor_hits", 0.0, []
    best = None
    for p in places[:: max(1, len(places) // 120)][:120] if len(places) > 120 else places:
        line = words[flat[p][1]][2]
        near = [i for i, w in enumerate(words) if abs(w[2] - line) <= 2]
        inside = [q for q, (_, i) in enumerate(flat) if min(near) <= i <= max(near)]
        for back in (0, 5, 10, 20):
            start, end, met = max(inside[0], p - back), inside[-1] + 1, []
            for q in range(start, min(end, start + 6 * len(toks) + 50)):
                if len(met) < len(toks) and same(toks[len(met)], flat[q][0]):
                    met.append(q)
            if not met:
                continue
            coverage = len(met) / len(toks) * (0.6 if any(map(has, toks)) and not any(has(flat[q][0]) for q in met) else 1)
            own = sorted({flat[q][1] for q in met})
            a, b = skel(label), skel(" ".join(words[i][0] for i in own))
            ratio = difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0
            runs, last = [], None
            for i in sorted(own, key=lambda i: (words[i][2], i)):
                if last is None or words[i][2] - last > 1:
                    runs.append([])
                runs[-1].append(i)
                last = words[i][2]
            boxes = [align.around([words[i][1] for i in r]) for r in runs]
            rate = [align.overlap(pred, x) - 0.1 * align.distance(pred, x) + 0.005 * len(r) for x, r in zip(boxes, runs)]
            box = boxes[rate.index(max(rate))]
            score = 0.7 * coverage + 0.3 * ratio + 0.15 * align.overlap(pred, box) - 0.1 * align.distance(pred, box)
            if best is None or score > best[0]:
                best = (score, coverage, ratio, align.overlap(pred, box), align.distance(pred, box), own)
    if best is None:
        return "no_valid_candidate", 0.0, []
    return align.gate(len(toks), *best[1:5], True)[1].split(" ")[0], best[1], best[5]


def test_matcher_equals_plain_loops(spark):
    import random

    rng = random.Random(17)
    vocab = ["alpha", "beta", "gamma", "of", "the", "12,5", "12.5", "2024", "ﬁve", "Ünder", "x-ray", "--", "total"]
    words = [(rng.choice(vocab) + (" " + rng.choice(vocab) if rng.random() < 0.1 else ""), [(i // 5) * 10.0, (i % 5) * 100.0, (i // 5) * 10.0 + 8, (i % 5) * 100.0 + 90], i // 5) for i in range(90)]
    labels = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 7))) for _ in range(120)] + ["", " the of ", "nowhere", "foo bar baz"]
    pred = [100.0, 0.0, 130.0, 500.0]
    rows = spark.createDataFrame([("d", i, 0, [s], pred) for i, s in enumerate(labels)] + [("none", 1000, 0, ["alpha"], pred), (None, 1001, 0, ["alpha"], pred)], "doc_id string, row_id int, box_no int, labels array<string>, pred_box array<double>")
    w = spark.createDataFrame([("d", i, t, b, n) for i, (t, b, n) in enumerate(words)] + [("other", 0, "alpha", [0.0] * 4, 0)], "doc_id string, word_idx int, text string, bbox array<double>, line_idx int")
    got = {r.row_id: r.m for r in align.match_labels(rows, w, group_boxes=50).collect()}
    assert len(got) == len(rows.collect()) and got[1000] is None and got[1001] is None
    for i, s in enumerate(labels):
        reason, coverage, own = slow_match(s, pred, words)
        assert (got[i].reason.split(" ")[0], pytest.approx(got[i].coverage), got[i].words) == (reason, coverage, own), s


def test_a_label_whose_first_word_is_missing_has_no_coverage(spark):
    doc = align.Document(["bar", "baz"], [[0.0, 0.0, 1.0, 1.0]] * 2, [0, 0])
    assert align.match(doc, "foo bar baz", None, align.Options())["reason"] == "no_valid_candidate"
    assert align.match(doc, "bar nothing baz", None, align.Options())["coverage"] == pytest.approx(1 / 3)


def test_row_policies(spark):
    w = spark.createDataFrame([("a", i, t, [0.0, i * 100.0, 10.0, i * 100.0 + 90], 0) for i, t in enumerate("red green blue".split())], "doc_id string, word_idx int, text string, bbox array<double>, line_idx int")
    kind = "row_id int, image string, question string, answer string, possible_answers array<string>, bboxes array<struct<role:string,label:string,bbox:array<double>,is_semantic:boolean>>"
    near, far = [0.0, 0.0, 10.0, 90.0], [900.0, 900.0, 990.0, 990.0]
    rows = [
        (1, "x/a.png", "which?", "red", None, [("answer", "red", near, False), ("context", "nothing", far, False), ("context", " ", far, False), ("answer", "any", far, True)]),
        (2, "x/a.png", "which?", "q", None, [("answer", "absent", far, False)]),
        (3, "x/a.png", "How many?", "two", None, [("answer", "absent", far, False), ("answer", "red", far, False)]),
        (4, None, "which?", "q", None, [("answer", "red", near, False)]),
        (5, "x/none.png", "which?", "q", None, [("answer", "red", near, False)]),
        (6, "x/a.png", "which?", "q", None, None),
        (7, "x/a.png", "How many?", "3", None, [("answer", "absent", far, False)]),
    ]
    out, report = policies.verify_infovqa(spark.createDataFrame(rows, kind), w)
    got = {r.row_id: r for r in out.collect()}
    assert {i: r._route for i, r in got.items()} == {1: "ok", 2: "bad", 3: "ok", 4: "passed", 5: "missing", 6: "passed", 7: "bad"}
    assert [b.label for b in got[1].new_boxes] == ["red", " ", "any"] and got[1].new_boxes[0].meta.ocr_status == "verified" and got[3].new_boxes[1].meta.ocr_status == "corrected"
    assert got[2].new_boxes[0].bbox == far and got[2].new_boxes[0].meta.ocr_status == "failed" and got[5].bboxes is not None
    assert {(r.row_id, r.bbox_idx, r.action) for r in report.collect()} == {(1, 0, None), (1, 1, "removed_non_answer"), (2, 0, None), (3, 0, None), (3, 1, None), (7, 0, None)}
    sunk = [(r.row_id, r._sink) for r in policies.sinks(out, policies.INFOVQA_SINKS).collect()]
    assert sorted(sunk) == sorted([(i, "out") for i in range(1, 8)] + [(2, "fail"), (5, "fail"), (7, "fail")])
    doc = spark.createDataFrame([(1, "a.png", 2000.0, 500.0, "red", ["RED", "blue"], [(None, [0.0, 0.0, 10.0, 90.0])]), (2, "a.png", 100.0, 500.0, "blue", None, [("green", [10.0, 0.0, 19.0, 5.0]), (None, [1.0])]), (3, "a.png", 100.0, 100.0, "zzz", None, [(None, [1.0, 2.0, 3.0, 4.0])]), (4, None, 1.0, 1.0, "red", None, []), (5, "b.png", 1.0, 1.0, "red", None, [])], "row_id int, image string, width double, height double, answer string, possible_answers array<string>, boxes array<struct<label:string,bbox:array<double>>>")
    out, report = policies.correct_docvqa(doc, w)
    got = {r.row_id: r for r in out.collect()}
    assert {i: r._route for i, r in got.items()} == {1: "ok", 2: "ok", 3: "bad", 4: "no_image", 5: "missing"}
    assert got[1].new_boxes[0].bbox == [0.0, 0.0, 10.0, 90.0] and got[2].new_boxes[0].bbox == pytest.approx([10.0, 0.0, 19.0, 5.0]) and got[2].new_boxes[1].bbox == [1.0]
    assert got[2].new_boxes[0].meta.ocr_used_label == "green" and got[3].new_boxes[0].bbox == [1.0, 2.0, 3.0, 4.0]
    assert sorted(r.row_id for r in policies.sinks(out, policies.DOCVQA_SINKS).where("_sink = 'out'").collect()) == [1, 2]


def test_scan_of_many_files(spark, tmp_path):
    import gzip

    d = tmp_path / "in"
    d.mkdir()
    (d / "b.jsonl").write_text('{"a": 1}\n\nnot json\n[1]\n{"a": 2}\n')
    (d / "a.jsonl").write_text("".join(f'{{"a": {i}}}\n' for i in range(5000)))
    (d / "c.txt").write_text("other")
    with gzip.open(d / "z.jsonl.gz", "wt") as f:
        f.write('{"a": 9}\n')
    files = jsonl.expand(spark, [str(d / "b.jsonl"), str(d), str(d / "*.jsonl")])
    assert [f.rpartition("/")[2] for f in files] == ["b.jsonl", "a.jsonl", "z.jsonl.gz"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = jsonl.scan(spark, [str(d / "b.jsonl"), str(d)]).collect()
        rows = sorted((r.file_no, r.line_no, r.raw) for r in got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(n, line) for n, line, _ in rows if n == 0] == [(0, 1), (0, 3), (0, 4), (0, 5)]
    assert [r for r in rows if r[0] == 1] == [(1, i + 1, f'{{"a": {i}}}') for i in range(5000)] and rows[-1] == (2, 1, '{"a": 9}')
    from pyspark.sql import Observation

    seen = Observation()
    assert jsonl.scan(spark, str(d / "b.jsonl"), on_bad="count", counts=seen).count() == 2 and seen.get == {"rows_in": 4, "rows_ok": 2, "rows_bad": 2}
    assert jsonl.scan(spark, str(d / "b.jsonl"), on_bad="raw").where("parse_error is not null").count() == 0
    ok, bad = (jsonl.scan(spark, str(d / "b.jsonl")).where(c).count() for c in ("parse_error is null", "parse_error is not null"))
    assert ok + bad == 4 and jsonl.line_count(spark, str(d / "b.jsonl")) == 5
    df, seen = jsonl.counted(spark.range(10), even=F.col("id") % 2 == 0)
    assert df.count() == 10 and seen.get == {"rows": 10, "even": 5}
    with pytest.raises(FileNotFoundError):
        jsonl.expand(spark, str(d / "none*"))


def test_line_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, '{"b": 1, "a": "é"}', "ok"), (2, '{"c": null}', "bad")], "n int, raw string, _route string")
    got = [r[0] for r in df.orderBy("n").select(jsonl.without_keys("raw", F.array(F.lit("b")))).collect()]
    assert got == ['{"a": "é"}', '{"c": null}']
    assert df.orderBy("n").select(jsonl.pretty("raw")).first()[0] == '{\n  "a": "é",\n  "b": 1\n}'
    for mode in ("errorifexists", "append"):
        jsonl.write_split(df, str(tmp_path / "split"), mode=mode)
    assert spark.read.text(str(tmp_path / "split")).groupBy("route").count().orderBy("route").collect() == [("bad", 2), ("ok", 2)]
    whole = "\n".join(r.value for r in jsonl.pretty_array(df, ["n"]).collect())
    assert json.loads(whole) == [{"a": "é", "b": 1}, {"c": None}]
    jsonl.write_pretty(df.withColumn("stem", jsonl.pretty_stem(F.col("n"), F.lit("x/--a b.mp4"))), str(tmp_path / "pretty"), "stem")
    assert sorted(p.name for p in (tmp_path / "pretty").glob("stem=*")) == ["stem=000001_a_b.mp4", "stem=000002_a_b.mp4"]
    words = spark.createDataFrame([("d", 1, "b"), ("d", 0, "a"), ("e", 0, None)], "doc_id string, word_idx int, text string")
    jsonl.write_words(words, str(tmp_path / "words"))
    assert [json.loads(r.value)["text"] for r in spark.read.text(str(tmp_path / "words/doc_id=d")).collect()] == ["a", "b"]
    (tmp_path / "targets.txt").write_text("b.mp4\n\n a.mp4 \n")
    names = lambda *a: [r.target for r in jsonl.target_list(spark, *a).orderBy("ord").collect()]
    assert names(["x"], str(tmp_path / "targets.txt"), ["d"]) == ["x"] and names(None, str(tmp_path / "targets.txt"), ["d"]) == ["b.mp4", "a.mp4"] and names(None, None, ["d"]) == ["d"]
    assert json.loads(jsonl.preview(df, 1))["columns"]["n"] == "int"


def test_assets(spark, tmp_path):
    import os
    import zipfile

    src = tmp_path / "src"
    src.mkdir()
    (src / "a.png").write_bytes(b"one")
    (src / "b.png").write_bytes(b"two")
    out = tmp_path / "out"
    plan = spark.createDataFrame([(str(src / "a.png"), str(out / "a.png"), "copy"), (str(src / "b.png"), str(out / "b.png"), "skip")], "src string, dst string, action string")
    did = lambda **k: sorted(r.did for r in assets.copy_files(plan, **k).collect())
    assert did() == ["copied", "skipped"] and did() == ["skipped", "skipped"] and did(overwrite=True) == ["copied", "skipped"] and did(overwrite=True, symlink=True) == ["linked", "skipped"]
    assert os.path.islink(out / "a.png") and (out / "a.png").read_bytes() == b"one"
    assert assets.zip_folder(str(src), str(tmp_path / "z.zip")) == 2 and zipfile.ZipFile(tmp_path / "z.zip").namelist() == ["a.png", "b.png"]
    assert sorted(r.path.rpartition("/")[2] for r in assets.listing(spark, str(src), [".PNG"]).collect()) == ["a.png", "b.png"]
    assert assets.download_patterns("metadata") == ["*.jsonl", "**/*.jsonl"] and assets.download_patterns("metadata", ["x"]) == ["x"] and len(assets.download_patterns()) == 4
    assert assets.chosen_files(["a.jsonl", "d/b.jsonl", "c.tar.gz"], assets.download_patterns("metadata"), ["d/*"]) == ["a.jsonl"]
    pages = spark.createDataFrame([("k1", "1.jpg", b"x"), ("k1", "2.jpg", b"y"), ("k2", "1.jpg", None)], "deck_id string, name string, bytes binary")
    decks = tmp_path / "decks"
    decks.mkdir()
    run = lambda: sorted((r.deck, r.n_files, r.did) for r in assets.materialise(pages, str(decks)).collect())
    assert run() == [("k1", 2, "written"), ("k2", 1, "written")] and run() == [("k1", 0, "kept"), ("k2", 0, "kept")]
    assert sorted(p.name for p in (decks / "k1").iterdir()) == [".complete", "1.jpg", "2.jpg"]
    as_image = lambda df: assets.image_struct(df, "c").first().c
    assert tuple(as_image(spark.createDataFrame([("p.png",)], "c string"))) == (None, "p.png") and bytes(as_image(spark.createDataFrame([(b"z",)], "c binary")).bytes) == b"z"
    assert tuple(as_image(spark.createDataFrame([(("q",),)], "c struct<path:string>"))) == (None, "q")
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("part-*"))
    (tmp_path / "shards").mkdir()
    for n in ("validation-00000-of-00001.parquet", "train-x.parquet"):
        (tmp_path / "shards" / n).write_bytes(part.read_bytes())
    assert sorted(r.split for r in assets.read_shards(spark, str(tmp_path / "shards")).collect()) == ["train", "val"]


def test_tar_links_and_modes(spark, tmp_path):
    import io
    import os

    with tarfile.open(tmp_path / "a.tar", "w") as t:
        def add(name, kind=tarfile.REGTYPE, link="", data=b"", mode=0o640):
            m = tarfile.TarInfo(name)
            m.type, m.linkname, m.size, m.mode, m.mtime = kind, link, len(data), mode, 1000
            t.addfile(m, io.BytesIO(data))

        add("d", tarfile.DIRTYPE, mode=0o755)
        add("d/f", data=b"body")
        add("d/soft", tarfile.SYMTYPE, "f")
        add("d/hard", tarfile.LNKTYPE, "d/f")
        add("d/bad", tarfile.SYMTYPE, "../../etc")
        add("../out", data=b"x")
    out = tmp_path / "out"
    got = {r.path: r.did for r in assets.extract_tar(spark, [str(tmp_path / "a.tar")], str(out)).collect()}
    assert got == {"d": "made", "d/f": "written", "d/soft": "linked", "d/hard": "linked", "d/bad": "refused", "../out": "refused"}
    assert (out / "d/soft").read_bytes() == b"body" and os.path.samefile(out / "d/hard", out / "d/f") and oct(os.stat(out / "d/f").st_mode)[-3:] == "640" and os.stat(out / "d/f").st_mtime == 1000


def test_text_and_boxes_that_no_query_reaches(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    assert one(tx.norm_basic(F.lit(" Ｆｕｌｌ ﬁx "))) == "full fix"
    assert [one(tx.sequence_ratio(F.lit(a), F.lit(b))) for a, b in (("abcd", "bcde"), ("", "a"), ("x", "x"))] == [0.75, 0.0, 1.0]
    assert one(tx.wrapped(F.lit("aaa bbb cc"), F.lit(4))) == ["aaa", "bbb", "cc"] and one(tx.wrapped(F.lit("cccccc"), F.lit(4))) == ["cccc", "cc"] and one(tx.wrapped(F.lit(""), F.lit(4))) == [""]
    assert [one(tx.first_number(F.array(*map(F.lit, xs)))) for xs in (["about 12345678901"], ["see a. and"], ["a dozen"], ["none", "Three items"], [" "])] == [12345678901, None, 1, 3, None]
    assert one(tx.mime_type(F.lit("a/b.JPEG"))) == "image/jpeg" and one(tx.safe_stem(F.lit("é b/c"))) == "é_b_c"
    assert one(tx.py_round(F.lit(2.675), F.lit(2))) == 2.67 and one(geom.round_box(F.array(*map(F.lit, (0.125, 1.0, 2.0, 3.0))))) == [0.12, 1.0, 2.0, 3.0]
    assert one(geom.looks_normalised(F.array(F.array(*map(F.lit, (1.0, 2.0, 3.0, 999.0)))), F.lit(1300), F.lit(10)))
    assert one(geom.norm1000_out(F.array(*map(F.lit, (0.0, 500.0, 1200.0, 1000.0))), F.lit(201), F.lit(100))) == [100.0, 0.0, 201.0, 100.0]
    assert [r.row_id for r in filters.most_rows(spark.range(9).withColumnRenamed("id", "row_id"), 2).collect()] == [0, 1]
    rows = filters.most_rows(spark.range(9).selectExpr("id as row_id", "id % 2 as s"), 2, by="s").collect()
    assert sorted(r.row_id for r in rows) == [0, 1, 2, 3]
    x = spark.createDataFrame([(1, [[1.0, 2.0, 3.0, 4.0]])], "id int, seed_boxes array<array<double>>")
    reply = spark.createDataFrame([(1, None, "e")], "id int, reply string, error string")
    assert [len(records.merge_replies(x, reply, "id", keep_seeds=k).first().bboxes) for k in (True, False)] == [1, 0]
