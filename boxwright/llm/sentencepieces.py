"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are marked (a space becomes the word mark, one mark in front) and cut into marked words; no piece of such a vocabulary
has a mark after another character, and none has a line feed, so pieces never cross the cuts. Distinct marked words are
sorted, which makes them the leaves of a trie in depth-first order; the forward state at each depth is kept on a stack, so that
a word starts where it leaves the word before.

For a unigram model the forward state is the best score and its last piece: plain Viterbi. For a BPE model, whose pieces are
those that merging by priority gives, a sum of scores would choose other pieces. There the forward state is the last piece
of the prefix's encoding: a piece can follow another only if merging the two strings by priority gives just these two, and
exactly one piece that ends at a place fits the state where it begins; the forward score is the sum of its pieces' scores. Prefixes of an encoding are encodings of prefixes, which
is what makes the state shareable. Words that start with several marks are merged directly, because marks' pieces share one priority.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .chunks import ChunkTable, gather
from .shared import table
from .words import blocks, text_buffers
from .workers import give_back, kept, lean

MARK = "▁"


class PieceEncoder(ChunkTable):
    """Ids of a SentencePiece model (BPE or unigram) with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__("<u2")
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.vocab_size()
        self.dtype = "<u2" if n <= 1 << 16 else "<u4"
        self.forget()
        names = [m.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.id = {names[i]: i for i in plain}
        self.score = {names[i]: m.get_score(i) for i in plain}
        self.longest = max(map(len, self.id))
        self.byte = {int(names[i][3:-1], 16): i for i in range(n) if m.is_byte(i)}
        self.unknown = m.unk_id()
        if any(MARK in x.lstrip(MARK) or "\n" in x for x in self.id):
            raise ValueError("pieces of this model cross words")
        self.bpe = _model_type(m.serialized_model_proto()) == 2
        self.fits: dict[tuple[str, str], bool] = {}
        outs = [b""] * n
        for i in plain:
            outs[i] = names[i].replace(MARK, " ").encode()
        for b, i in self.byte.items():
            outs[i] = bytes((b,))
        outs[self.unknown] = " ⁇ ".encode()
        self.out_flat = np.frombuffer(b"".join(outs), np.uint8)
        self.out_n = np.fromiter(map(len, outs), np.int64, n)
        self.out_at = np.cumsum(self.out_n) - self.out_n

    # --- encoding

    def merge(self, s: str) -> list[str]:
        """Pieces by merging neighbours by priority: the best score first, of equal ones the leftmost. A heap of possible merges keeps long
        runs from being scanned again for each."""
        score, piece = self.score, list(s)
        before, after = list(range(-1, len(s) - 1)), list(range(1, len(s) + 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(s):
                both = piece[i] + piece[after[i]]
                v = score.get(both)
                if v is not None:
                    heapq.heappush(heap, (-v, i, both))

        for i in range(len(s)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not piece[i] or j >= len(s) or len(piece[i]) + len(piece[j]) != len(both) or piece[i] + piece[j] != both:
                continue  # one of the two is part of another piece by now
            piece[i], piece[j] = both, ""
            after[i] = after[j]
            if after[j] < len(s):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in piece if x]

    def follows(self, a: str, b: str) -> bool:
        ok = self.fits.get((a, b))
        if ok is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            ok = self.fits[(a, b)] = self.merge(a + b) == [x for x in (a, b) if x]
        return ok

    def segment_sorted(self, words: list[str]) -> Iterator[list[str]]:
        """Pieces of sorted words, depth first: states of the prefix shared with the word before are reused."""
        last: list[str] = [""]  # by depth: the last piece of the prefix's segmentation
        best: list[float] = [0.0]
        before = ""
        known, longest = self.score, self.longest
        for w in words:
            depth, most = 0, min(len(w), len(before))
            while depth < most and w[depth] == before[depth]:
                depth += 1
            del last[depth + 1 :], best[depth + 1 :]
            for i in range(depth + 1, len(w) + 1):
                if self.bpe:
                    last.append(self._bpe_state(w, i, last))
                    best.append(best[i - len(last[i])] + known.get(last[i], -1e6))
                else:
                    piece, top = w[i - 1], best[i - 1] - 1e6  # a character that is no piece
                    for j in range(max(0, i - longest), i):
                        v = known.get(w[j:i])
                        if v is not None and best[j] + v > top:
                            piece, top = w[j:i], best[j] + v
                    last.append(piece)
                    best.append(top)
            before, out, i = w, [], len(w)
            while i:
                out.append(last[i])
                i -= len(last[i])
            yield out[::-1]

    def _bpe_state(self, w: str, i: int, last: list[str]) -> str:
        known = self.score
        for j in range(max(0, i - self.longest), i):
            x = w[j:i]
            if (x in known or j == i - 1) and self.follows(last[j], x):
                return x
        raise AssertionError(f"no piece ends at {i} of {w!r}")

    def encode_new(self, chunks: list[str]) -> list[list[int]]:
        words = [c.replace(" ", MARK) for c in chunks]
        pieces: dict[str, list[str]] = {w: self.merge(w) for w in words if w.startswith(MARK * 2)}
        rest = sorted({w for w in words if w not in pieces})
        pieces |= zip(rest, self.segment_sorted(rest), strict=True)
        return [self._ids(pieces[w]) for w in words]

    def _ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, n+1 offsets into them)."""
        if (raw == 0xE2).any() and MARK.encode() in raw.tobytes():  # a mark in the text itself is the same as a space
            text = raw.tobytes()
            parts = [text[a:b].replace(MARK.encode(), b" ") for a, b in zip(offs, offs[1:])]
            raw, offs = np.frombuffer(b"".join(parts), np.uint8), np.r_[0, np.cumsum([len(x) for x in parts])]
        full = np.diff(offs) > 0
        raw = np.insert(raw, offs[:-1][full], 32)
        offs = offs + np.r_[0, np.cumsum(full)]
        space = raw == 32
        start = space & ~np.r_[False, space[:-1]]
        feed = raw == 10
        start |= feed
        start[1:] |= feed[:-1]
        start[offs[:-1][full]] = True
        return self.encode_chunks(raw, np.flatnonzero(start), offs)

    # --- decoding

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of rows of ids; bytes that are no UTF-8 come out as U+FFFD."""
        flat, total = gather(self.out_flat, self.out_at[ids], self.out_n[ids])
        at, data = np.r_[0, total][bounds].tolist(), flat.tobytes()
        return [data[a + (data[a : a + 1] == b" ") : b].decode(errors="replace") if a < b else "" for a, b in zip(at, at[1:])]


def _model_type(proto: bytes) -> int:
    """trainer_spec.model_type (1 unigram, 2 BPE) of a serialized model: field 3 of the message's field 2."""

    def fields(buf: bytes):
        at = 0

        def number() -> int:
            nonlocal at
            x = shift = 0
            while True:
                b = buf[at]
                at += 1
                x |= (b & 127) << shift
                shift += 7
                if b < 128:
                    return x

        while at < len(buf):
            key = number()
            kind = key & 7
            if kind == 0:
                yield key >> 3, number()
            elif kind == 2:
                n = number()
                yield key >> 3, buf[at : at + n]
                at += n
            else:
                at += {1: 8, 5: 4}[kind]
                yield key >> 3, None

    for tag, value in fields(proto):
        if tag == 2:
            return next((v for t, v in fields(value) if t == 3), 1)
    return 1


def encoder(path: str) -> PieceEncoder:
    return kept(("pieces", path), lambda: PieceEncoder(path))


def _encoding(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            raw, offs = text_buffers(batch.column(1))
            for i, j in blocks(offs, 1 << 20):
                ids, b = enc.encode(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])
                give_back()  # new chunks leave as much behind as the table holds

    return run


def _decoding(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                col = batch.column(1).slice(at, 1000)
                ids = col.flatten().to_numpy().astype(np.int64)
                n = np.array([len(x) if x.is_valid else 0 for x in col]) if col.null_count else np.diff(col.offsets.to_numpy())
                bounds = np.r_[0, np.cumsum(n)]
                data, cuts = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1000), pa.array(n, pa.int64()), pa.array([zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()), pa.array(enc.decode(ids, bounds), mask=col.is_null().to_numpy(zero_copy_only=False))],
                    names=["doc_id", "n_tokens", "ids_crc32", "text"],
                )

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): a row for every row. A null or empty text has no ids. Other columns are ignored."""
    return _texts(docs, id_col, text_col).mapInArrow(lean(_encoding(model), keeps=True), "doc_id long, ids array<int>")


DECODED = "doc_id long, n_tokens long, ids_crc32 long, text string"


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, n_tokens, ids_crc32, text). Null ids give a null text, ids without entries an empty one."""
    return encoded.mapInArrow(lean(_decoding(model), keeps=True), DECODED)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode_documents(encode_documents(docs)) with one worker a task in place of two, which would each hold the model beside the other."""
    encode, decode = _encoding(model), _decoding(model)
    return _texts(docs, id_col, text_col).mapInArrow(lean(lambda batches: decode(encode(batches)), keeps=True), DECODED)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = round_trip(table(spark, sf_dir, "documents"), model)
    return out.select("doc_id", "n_tokens", "ids_crc32", F.length("text").cast("long").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))
