"""Ids of texts by way of distinct chunks: a chunk that occurs often is encoded once, and rows are put together in numpy."""

from __future__ import annotations

import itertools

import numpy as np

from .words import span_hash

#: Distinct chunks that a worker remembers before it starts anew.
MEMORY = 2_000_000
#: Bytes that are compared at once.
PIECE = 1 << 17


class ChunkTable:
    """Known chunks as sorted 64-bit hashes with their bytes and ids. Subclasses say how new chunks are encoded.

    A hash only finds a chunk; its bytes are then compared. Chunks whose hash belongs to another chunk are kept aside by their bytes.
    """

    def __init__(self, dtype: str):
        self.dtype = dtype
        self.forget()

    def forget(self) -> None:
        self.keys, self.at, self.n, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)
        self.text, self.text_at, self.text_n = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.aside: dict[bytes, tuple[int, int]] = {}

    def encode_new(self, chunks: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _add_ids(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter(map(len, found), np.int64, len(found))
        at = np.cumsum(n) - n + len(self.ids)
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(n.sum()))])
        return at, n

    def encode_chunks(self, raw: np.ndarray, start: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, n+1 offsets into them) for chunks that begin at `start`; every row begins a chunk."""
        if not len(start):
            return np.zeros(0, self.dtype), np.zeros(len(offs), np.int64)
        key, first, back = np.unique(span_hash(raw, start), return_index=True, return_inverse=True)
        if len(self.keys) > MEMORY:
            self.forget()
        size = np.diff(np.r_[start, len(raw)])
        place = np.searchsorted(self.keys, key)
        new = np.flatnonzero(np.r_[self.keys, np.uint64(0)][place] != key) if len(self.keys) else np.arange(len(key))
        if len(new):
            data, begin, end = raw.tobytes(), start[first[new]], start[first[new]] + size[first[new]]
            at, n = self._add_ids(self.encode_new([data[a:b].decode() for a, b in zip(begin.tolist(), end.tolist())]))
            text, _ = gather(raw, begin, end - begin)
            text_at = np.cumsum(end - begin) - (end - begin) + len(self.text)
            self.text = np.concatenate([self.text, text])
            own = ("keys", key[new]), ("at", at), ("n", n), ("text_at", text_at), ("text_n", end - begin)
            for name, values in own:
                setattr(self, name, np.insert(getattr(self, name), place[new], values))
            place = np.searchsorted(self.keys, key)
        at, n = self.at[place][back], self.n[place][back]
        odd = np.flatnonzero(~same_bytes(raw, start, size, self.text, self.text_at[place][back], self.text_n[place][back]))
        for i in odd.tolist():  # another chunk has this hash
            text = raw[start[i] : start[i] + size[i]].tobytes()
            if text not in self.aside:
                one_at, one_n = self._add_ids(self.encode_new([text.decode()]))
                self.aside[text] = int(one_at[0]), int(one_n[0])
            at[i], n[i] = self.aside[text]
        ids, total = gather(self.ids, at, n)
        return ids, np.r_[0, total][np.searchsorted(start, offs)]


def same_bytes(a: np.ndarray, a_at: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_n: np.ndarray) -> np.ndarray:
    """Whether the span of a (spans in a row up to its end) equals that of b, for each pair of spans. Works through pieces of a."""
    out = a_n == b_n
    step = max(1, len(a_at) * PIECE // max(1, len(a)))
    for i in range(0, len(a_at), step):
        own = slice(i, i + step)
        start, n, ok = a_at[own], a_n[own], out[own]
        piece = a[start[0] : start[-1] + n[-1]]
        at = np.repeat(np.where(ok, b_at[own], 0) - (start - start[0]), n)
        at += np.arange(len(piece))
        if not ok.all():  # lengths differ: any bytes will do
            np.minimum(at, len(b) - 1, out=at)
        wrong = np.flatnonzero(b[at] != piece)
        if len(wrong):
            out[i + np.searchsorted(start - start[0], wrong, "right") - 1] = False
    return out


def gather(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[at:at+n] of every span in a row, and the running total of n."""
    total = np.cumsum(n)
    return flat[np.repeat(at - (total - n), n) + np.arange(int(total[-1]) if len(n) else 0)], total
