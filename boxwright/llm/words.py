"""Words of Arrow text batches as numpy arrays: no loop over rows or words in Python.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased. UTF-8 continuation bytes are never
white space, so byte-wise splitting equals splitting by characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are held as numpy arrays at once; one longer text is a block of its own.
BLOCK_BYTES = 1 << 20
PIECE_BYTES = 1 << 17

_factors = np.zeros(0, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def factors(idx: np.ndarray) -> np.ndarray:
    """An odd pseudo-random multiplier for each place in a span: multilinear hashing, which unlike powers of one base has no
    long words that collide for every base."""
    global _factors
    if not len(_factors):
        _factors = mix64(np.arange(1 << 16, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    if not len(idx) or int(idx.max()) < len(_factors):
        return _factors[idx]
    return mix64(idx.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string column; nulls have length 0."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    raw = raw[offs[0] : offs[-1]]
    return raw, offs - offs[0]


def blocks(offs: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) of at most `most` bytes, or one row."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def span_hash(raw: np.ndarray, starts: np.ndarray, inside: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes from each start to the next start (the last to the end); bytes not `inside` don't count."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    step = max(1, len(starts) * PIECE_BYTES // max(1, len(raw)))
    for i in range(0, len(starts), step):  # pieces that fit a core's cache
        at = starts[i : i + step]
        end = starts[i + step] if i + step < len(starts) else len(raw)
        piece, at = raw[at[0] : end], at - at[0]
        idx = np.arange(len(piece), dtype=np.int32) - np.repeat(at.astype(np.int32), np.diff(np.r_[at, len(piece)]))
        values = piece.astype(np.uint64) + np.uint64(1)
        if inside is not None:
            values *= inside[end - len(piece) : end]
            idx *= inside[end - len(piece) : end]
        values *= factors(idx)
        out[i : i + step] = np.add.reduceat(values, at)
    return mix64(out)


class Words:
    """Words of a block: start and end (byte positions in `raw`), row of each word, 64-bit hash, first word of each row."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        n_rows = len(offs) - 1
        low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        first = np.zeros(len(raw) + 1, bool)
        first[offs[:-1]] = True  # a row's first byte starts a word of its own
        before = np.r_[False, inside[:-1]] if len(raw) else inside
        starts = np.flatnonzero(inside & (~before | first[:-1]))
        after = np.r_[inside[1:], False] if len(raw) else inside
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.low, self.start, self.end, self.n_rows = low, starts, ends, n_rows
        self.row = np.searchsorted(offs, starts, "right") - 1
        self.bounds = np.searchsorted(starts, offs).astype(np.int64)  # words of row i: bounds[i]:bounds[i+1]
        self.hash = span_hash(low, starts, inside)


def word_blocks(col: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    raw, offs = text_buffers(col)
    for i, j in blocks(offs, most):
        yield i, j, Words(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit hash) of every k-word shingle in order; a row of 1 to k-1 words has its whole sequence as one."""
    h, b = w.hash, w.bounds
    n = np.diff(b)
    rows, out = [], []
    if len(h) >= k:
        s = h[: len(h) - k + 1].copy()
        for t in range(1, k):
            s = mix64(s * np.uint64(0xD6E8FEB86659FD93) + h[t : len(h) - k + 1 + t])
        ok = w.row[: len(s)] == w.row[k - 1 :]
        rows.append(w.row[: len(s)][ok])
        out.append(s[ok])
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        s = h[b[short]].copy()
        for t in range(1, k - 1):
            more = n[short] > t
            s[more] = mix64(s[more] * np.uint64(0xD6E8FEB86659FD93) + h[np.minimum(b[short] + t, len(h) - 1)][more])
        rows.append(short)
        out.append(mix64(s ^ n[short].astype(np.uint64)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(out)
