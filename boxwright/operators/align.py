"""Alignment of box labels with OCR words, and the row policies on top of it.

Rows and words of one document meet in a join on the document; a label and its document's words then go through one Arrow
function per row batch. The relational pieces (anchors, windows, clusters, gates) also stand alone in functions.text and
operators.joins, where SQL checks them.
"""

from __future__ import annotations

import difflib
import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from boxwright.functions.geom import DIAGONAL, iou
from boxwright.functions.text import STOPWORDS


@dataclass
class Options:
    window_words: int = 120
    window_lines: int = 2
    lambda_iou: float = 0.15
    lambda_dist: float = 0.10
    max_candidates: int = 120
    max_scan_mult: int = 6
    by_line_cluster: bool = True


# How far before an anchor a scan starts, and the gates (most tokens, coverage, character ratio).
BACK = (0, 5, 10, 20)
GATES = ((4, 0.75, 0.55), (10, 0.65, 0.50), (10**9, 0.55, 0.45))

MATCH = "ok boolean, reason string, score double, coverage double, char_ratio double, iou double, dist double, box array<double>, words array<int>"


def norm(s: str) -> str:
    return unicodedata.normalize("NFKC", s or "").lower().strip()


def skeleton(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", norm(s))


def number(s: str) -> str:
    x = re.sub(r"[^0-9.]", "", re.sub(r"(?<=\d),(?=\d)", ".", norm(s)))
    head, dot, tail = x.partition(".")
    return head + dot + tail.replace(".", "")


def form(t: str) -> tuple[str, str | None]:
    """What tokens are compared by: the skeleton, and the number of a token with digits."""
    return skeleton(t), number(t) if re.search("[0-9]", t) else None


def equivalent(a: tuple, b: tuple) -> bool:
    return a[0] == b[0] or (a[1] is not None and a[1] == b[1])


def overlap(p: list[float], q: list[float]) -> float:
    inter = max(0.0, min(p[2], q[2]) - max(p[0], q[0])) * max(0.0, min(p[3], q[3]) - max(p[1], q[1]))
    size = lambda b: max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1])
    union = size(p) + size(q) - inter
    return inter / union if union > 0 else 0.0


def distance(p: list[float], q: list[float]) -> float:
    return math.hypot((p[0] + p[2] - q[0] - q[2]) / 2, (p[1] + p[3] - q[1] - q[3]) / 2) / DIAGONAL


def around(boxes: list[list[float]]) -> list[float]:
    return [min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)]


class Document:
    """Words in order (text, box, line or None); tokens with the word they come from; places of token skeletons."""

    def __init__(self, texts: list[str], boxes: list, lines: list):
        keep = [i for i, b in enumerate(boxes) if b is not None and len(b) == 4 and all(v is not None for v in b)]
        self.text, self.box = [texts[i] or "" for i in keep], [[float(v) for v in boxes[i]] for i in keep]
        self.line = [None if lines[i] is None or lines[i] != lines[i] else int(lines[i]) for i in keep]
        self.token, self.word, first = [], [], [0]
        for i, t in enumerate(self.text):
            for x in norm(t).split():
                self.token.append(x)
                self.word.append(i)
            first.append(len(self.token))
        self.first = first  # tokens of word i: first[i]:first[i + 1]
        self.form = [form(x) for x in self.token]
        self.places: dict[str, list[int]] = {}
        for p, (x, _) in enumerate(self.form):
            self.places.setdefault(x, []).append(p)
        self.span: dict[int, tuple[int, int]] = {}
        for i, n in enumerate(self.line):
            if n is not None:
                a, b = self.span.get(n, (i, i))
                self.span[n] = (min(a, i), max(b, i))

    def window(self, place: int, o: Options) -> tuple[int, int]:
        """Tokens of the words around the word of a token."""
        w = self.word[place]
        line = self.line[w]
        if line is None:
            lo, hi = max(0, w - o.window_words), min(len(self.text) - 1, w + o.window_words)
        else:
            near = [self.span[n] for n in range(line - o.window_lines, line + o.window_lines + 1) if n in self.span]
            lo, hi = min(a for a, _ in near), max(b for _, b in near)
        return self.first[lo], self.first[hi + 1]

    def cluster_box(self, words: list[int], pred: list[float] | None, o: Options) -> list[float]:
        """Box of the best run of lines without a gap; words without a line count only if none has one."""
        lined = [w for w in words if self.line[w] is not None]
        if not o.by_line_cluster or not lined:
            return around([self.box[w] for w in words])
        runs: list[list[int]] = []
        last = None
        for w in sorted(lined, key=lambda w: (self.line[w], w)):
            if last is None or self.line[w] - last > 1:
                runs.append([])
            runs[-1].append(w)
            last = self.line[w]
        best, top = None, None
        for r in runs:
            box = around([self.box[w] for w in r])
            s = float(len(r)) if pred is None else overlap(pred, box) - 0.1 * distance(pred, box) + 0.005 * len(r)
            if top is None or s > top:
                best, top = box, s
        return best


def match(doc: Document, label: str, pred: list[float] | None, o: Options) -> dict:
    """The best place of a label among a document's words, and whether it passes the gates."""
    failed = lambda why: {"ok": False, "reason": why, "score": 0.0, "coverage": 0.0, "char_ratio": 0.0, "iou": 0.0, "dist": 1.0, "box": None, "words": []}
    toks = norm(label).split()
    toks = [t for t in toks if t not in STOPWORDS] or toks
    if not toks:
        return failed("empty_label_tokens")
    wanted = [t for t in toks if t not in STOPWORDS and skeleton(t)]
    value = lambda t: (10.0 if re.search("[0-9]", t) else 0.0) + min(len(skeleton(t)), 12) / 12.0 * 2.0
    hits = sorted({p for t in sorted(wanted, key=lambda t: -value(t))[:5] for p in doc.places.get(skeleton(t), ())})
    if not hits:
        return failed("no_anchor_hits")
    if len(hits) > o.max_candidates:
        hits = hits[:: len(hits) // o.max_candidates][: o.max_candidates]
    digits, best = any(re.search("[0-9]", t) for t in toks), None
    forms = [form(t) for t in toks]
    for place in hits:
        lo, hi = doc.window(place, o)
        for back in BACK:
            start = max(lo, place - back)
            stop = start + min(hi - start, o.max_scan_mult * len(toks) + 50)
            got: list[int] = []
            for p in range(start, stop):  # the scan waits for one token after the other and never passes one over
                if equivalent(forms[len(got)], doc.form[p]):
                    got.append(p)
                    if len(got) == len(toks):
                        break
            if not got:
                continue
            coverage = len(got) / len(toks)
            if digits and not any(re.search("[0-9]", doc.token[p]) for p in got):
                coverage *= 0.6
            words = sorted({doc.word[p] for p in got})
            a, b = skeleton(label), skeleton(" ".join(doc.text[w] for w in words))
            ratio = difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0
            box = [min(max(v, 0.0), 1000.0) for v in doc.cluster_box(words, pred, o)]
            share, dist = (overlap(pred, box), distance(pred, box)) if pred else (0.0, 1.0)
            score = 0.7 * coverage + 0.3 * ratio + o.lambda_iou * share - o.lambda_dist * dist
            if best is None or score > best["score"]:
                best = {"score": score, "coverage": coverage, "char_ratio": ratio, "iou": share, "dist": dist, "box": box, "words": words[:200]}
    if best is None:
        return failed("no_valid_candidate")
    ok, reason = gate(len(toks), best["coverage"], best["char_ratio"], best["iou"], best["dist"], pred is not None)
    return best | {"ok": ok, "reason": reason}


def gate(n: int, coverage: float, ratio: float, iou: float, dist: float, has_pred: bool) -> tuple[bool, str]:
    """One good signal is enough; below both, lower floors may still save it unless it lies far from the prediction."""
    cov, cr = next((c, r) for most, c, r in GATES if n <= most)
    if has_pred and dist <= 0.06:
        cov, cr = max(0.30, cov - 0.15), max(0.30, cr - 0.10)
    if coverage >= cov or ratio >= cr:
        return True, "ok"
    near = not has_pred or dist <= 0.12 or iou >= 0.02
    text = 0.7 * coverage + 0.3 * ratio >= 0.42 and max(coverage, ratio) >= 0.35
    if near and (coverage >= max(0.25, cov - 0.20) or ratio >= max(0.25, cr - 0.15) or text):
        return True, "ok_relaxed"
    return False, f"below_threshold cov={coverage:.3f} cr={ratio:.3f} dist={dist:.3f}"


def gate_columns(n: Column, coverage: Column, ratio: Column, iou: Column, dist: Column, has_pred: Column) -> Column:
    """gate() as an expression: the reason, without the figures."""
    cov = F.when(n <= 4, 0.75).when(n <= 10, 0.65).otherwise(0.55)
    cr = F.when(n <= 4, 0.55).when(n <= 10, 0.50).otherwise(0.45)
    close = has_pred & (dist <= 0.06)
    cov, cr = (F.when(close, F.greatest(F.lit(0.30), x - d)).otherwise(x) for x, d in ((cov, 0.15), (cr, 0.10)))
    near = ~has_pred | (dist <= 0.12) | (iou >= 0.02)
    text = (0.7 * coverage + 0.3 * ratio >= 0.42) & (F.greatest(coverage, ratio) >= 0.35)
    saved = near & ((coverage >= F.greatest(F.lit(0.25), cov - 0.20)) | (ratio >= F.greatest(F.lit(0.25), cr - 0.15)) | text)
    return F.when((coverage >= cov) | (ratio >= cr), "ok").when(saved, "ok_relaxed").otherwise("below_threshold")


#: Boxes of one document that one group of the matcher takes.
GROUP_BOXES = 2000


def match_labels(rows: DataFrame, words: DataFrame, options: Options | None = None, group_boxes: int = GROUP_BOXES) -> DataFrame:
    """rows (doc_id, row_id, box_no, labels array, pred_box) and words (doc_id, word_idx, text, bbox, line_idx) -> rows with `used_label` and `m`.

    Of several labels of a box the best passing one counts, else the best of all. Boxes of documents without words, or without document, get
    null. Only words of documents that rows name are moved; they meet their boxes in groups of at most about group_boxes, so a
    document with very many boxes is dealt over several groups, each with the document's words."""
    o = options or Options()
    parts = rows.where("doc_id is not null").groupBy("doc_id").agg(F.ceil(F.count("*") / group_boxes).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("row_id", "box_no"), F.coalesce("parts", F.lit(1))).cast("int")
    left = rows.join(parts, "doc_id", "left").withColumn("_part", own).select(*rows.columns, "_part")
    right = words.select("doc_id", "word_idx", "text", "bbox", "line_idx").join(parts, "doc_id")
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def run(boxes: pd.DataFrame, ws: pd.DataFrame) -> pd.DataFrame:
        boxes = boxes.drop(columns=["_part"])
        if ws.empty:
            return boxes.assign(used_label=None, m=None)
        ws = ws.sort_values("word_idx")
        doc = Document(list(ws["text"]), list(ws["bbox"]), [None if pd.isna(v) else v for v in ws["line_idx"]])
        used, out = [], []
        for labels, pred in zip(boxes["labels"], boxes["pred_box"], strict=True):
            p = None if pred is None else [float(v) for v in pred]
            tried = [(m["ok"], m["score"], -i, x, m) for i, x in enumerate(labels if labels is not None else []) for m in [match(doc, x, p, o)]]
            best = max(tried, key=lambda t: t[:3], default=None)
            used.append(best and best[3])
            out.append(best and best[4])
        return boxes.assign(used_label=used, m=out)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    nested = ", ".join(p.strip().replace(" ", ":", 1) for p in MATCH.split(", "))
    return left.groupBy("doc_id", "_part").cogroup(right.groupBy("doc_id", "_part")).applyInPandas(run, f"{fields}, used_label string, m struct<{nested}>")


def subsequence_count(label: Column, toks: Column) -> Column:
    """How many tokens of a label a scan over toks meets in order, waiting for one after the other."""
    return F.aggregate(toks, F.lit(0), lambda i, t: F.when((i < F.size(label)) & (F.get(label, i) == t), i + 1).otherwise(i))


def subsequence_coverage(label: Column, toks: Column) -> Column:
    """The greedy match's coverage over skeletons: the native half of the matcher."""
    return F.when(F.size(label) > 0, subsequence_count(label, toks) / F.size(label)).otherwise(F.lit(0.0))


def verify_boxes(matched: DataFrame) -> DataFrame:
    """Extractive verification: adds `status` to matched boxes (role, is_semantic): verified where the new box mostly agrees, corrected,
    failed (answers stay as they were), dropped (others), passed for boxes that aren't extractive, have a blank label, or
    whose document has no words."""
    label = F.get("labels", F.lit(0))
    skip = ~F.coalesce(F.col("is_semantic") == F.lit(False), F.lit(False)) | F.coalesce(F.trim(label) == "", F.lit(True)) | F.col("m").isNull()
    same = F.coalesce(iou(F.col("pred_box"), F.col("m.box")) >= 0.6, F.lit(False))
    status = F.when(skip, "passed").when(F.col("m.ok") & same, "verified").when(F.col("m.ok"), "corrected").when(F.col("role") == "answer", "failed").otherwise("dropped")
    return matched.withColumn("status", status).withColumn("new_box", F.when(F.col("status").isin("verified", "corrected"), F.col("m.box")).otherwise(F.col("pred_box")))


def verified_rows(boxes: DataFrame, how_many: Column | None = None) -> DataFrame:
    """One row per row_id: boxes that stay, and `_route` bad where an answer failed. Where how_many (the number that a question asks for; null
    for other questions, negative where it can't be read) is the number of answer boxes left, the row stays ok."""
    fails = F.bool_or(F.col("status") == "failed")
    answers = F.count_if((F.col("role") == "answer") & (F.col("status") != "dropped"))
    saved = F.coalesce(F.max(how_many) == answers, F.lit(False)) if how_many is not None else F.lit(False)
    return boxes.groupBy("row_id").agg(F.count_if(F.col("status") != "dropped").alias("n_boxes"), F.count_if(F.col("status").isin("verified", "corrected")).alias("n_matched"), F.when(fails & ~saved, "bad").otherwise("ok").alias("_route"))
