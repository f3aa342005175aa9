"""TIFF media columns: a writer, and a reader that walks image directories and gives one row per page.

The reader takes both byte orders; strips and tiles; 8-bit samples of 1 to 4 channels in chunky order; compression none (1),
LZW (5), deflate (8, 32946) and PackBits (32773); predictors none (1) and horizontal (2). Other predictors, planar samples, reversed bits and
sizes that a file's bytes can't hold are refused.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import cut, table

# TIFF tag numbers, value sizes by type, and compression codes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, FILL_ORDER, PLANAR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 317, 322, 323, 324, 325, 266, 284
TYPE_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773

#: Most bytes that one stored byte can stand for.
EXPANSION = {NONE: 1, LZW: 4096, DEFLATE: 1040, OLD_DEFLATE: 1040, PACKBITS: 64}

CLEAR, END = 256, 257


def _run_widths(n: int) -> np.ndarray:
    """Bits of the first n codes after a clear code: wider one code early, as TIFF has it."""
    size = 258 + np.arange(n)  # entries when a code is read; the first code adds none
    size = np.maximum(size - 1, 257) + 1
    return np.select([size < 511, size < 1023, size < 2047], [9, 10, 11], 12)


_WIDTHS = _run_widths(4096)
_STARTS = np.r_[0, np.cumsum(_WIDTHS)]


def lzw_encode(data: bytes) -> bytes:
    """TIFF LZW: clear code first, most significant bit first, end code last."""
    codes, widths = [np.array([CLEAR])], [np.array([9])]
    run: list[int] = []
    known: dict[int, int] = {}  # code of a string << 8 | next byte -> code of both
    get, add, nxt, w = known.get, run.append, 258, -1

    def close(last: int) -> None:
        """End a run; `last` (clear or end) has the width that the run's next code would have."""
        run.append(last)
        codes.append(np.array(run))
        widths.append(_WIDTHS[: len(run)])
        run.clear()

    for c in data:
        if w < 0:
            w = c
            continue
        key = w << 8 | c
        x = get(key)
        if x is not None:
            w = x
            continue
        add(w)
        known[key] = nxt
        nxt += 1
        w = c
        if nxt == 4094:
            close(CLEAR)
            known.clear()
            nxt = 258
    if w >= 0:
        add(w)
    close(END)
    code, width = np.concatenate(codes).astype(np.uint16), np.concatenate(widths)
    bits = np.unpackbits((code << (16 - width).astype(np.uint16)).astype(">u2").view(np.uint8)).reshape(-1, 16)
    return np.packbits(bits[np.arange(16)[None, :] < width[:, None]]).tobytes()


def lzw_decode(data: bytes) -> bytes:
    """Inverse of TIFF LZW; raises ValueError for codes that no table has."""
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    total, at, out = 8 * len(data), 0, []
    base = [bytes((i,)) for i in range(256)] + [b"", b""]
    while at + 9 <= total:
        # codes of a run have the widths that their places give; a clear or end code closes it
        n = min(4096, int(np.searchsorted(_STARTS, total - at, "right")) - 1)
        pos = at + _STARTS[:n]
        byte = pos >> 3
        three = (raw[byte].astype(np.int32) << 16) | (raw[byte + 1].astype(np.int32) << 8) | raw[byte + 2]
        codes = (three >> (24 - (pos & 7) - _WIDTHS[:n])) & ((1 << _WIDTHS[:n]) - 1)
        stop = np.flatnonzero((codes == CLEAR) | (codes == END))
        k = int(stop[0]) if len(stop) else n
        run = codes[:k].tolist()
        if run:
            if run[0] >= 256:
                raise ValueError("first code after a clear isn't a byte")
            known, prev = base.copy(), base[run[0]]
            add, put, size = known.append, out.append, 258
            put(prev)
            for code in run[1:]:
                if code < size:
                    x = known[code]
                elif code == size:
                    x = prev + prev[:1]
                else:
                    raise ValueError("unknown code")
                add(prev + x[:1])
                size += 1
                put(x)
                prev = x
        if not len(stop) or codes[k] == END:
            break
        at += int(_STARTS[k + 1])
    return b"".join(out)


_RUN = re.compile(rb"(.)\1{2,127}", re.S)


def packbits_encode(row: bytes) -> bytes:
    out, at = [], 0

    def literal(x: bytes) -> None:
        for i in range(0, len(x), 128):
            part = x[i : i + 128]
            out.append(bytes((len(part) - 1,)))
            out.append(part)

    for m in _RUN.finditer(row):
        literal(row[at : m.start()])
        out.append(bytes((257 - (m.end() - m.start()),)) + m[1])
        at = m.end()
    literal(row[at:])
    return b"".join(out)


def packbits_decode(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += n + 2
        elif n > 128:
            out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2
        else:
            at += 1
    return b"".join(out)


def _encode(block: np.ndarray, compression: int, predictor: int) -> bytes:
    """block: rows x columns x channels."""
    if predictor == 2:
        diff = block.copy()
        diff[:, 1:] -= block[:, :-1]
        block = diff
    if compression == PACKBITS:
        return b"".join(packbits_encode(r.tobytes()) for r in block)  # rows are packed each by itself
    raw = block.tobytes()
    return {NONE: lambda: raw, LZW: lambda: lzw_encode(raw), DEFLATE: lambda: zlib.compress(raw, 6)}[compression]()


def _decode(data: bytes, compression: int, predictor: int, rows: int, cols: int, channels: int) -> np.ndarray:
    if compression in (DEFLATE, OLD_DEFLATE):
        data = zlib.decompressobj().decompress(data, rows * cols * channels)
    elif compression == LZW:
        data = lzw_decode(data)
    elif compression == PACKBITS:
        data = packbits_decode(data)
    elif compression != NONE:
        raise ValueError(f"compression {compression} isn't supported")
    if len(data) < rows * cols * channels:
        raise ValueError("a strip or tile is cut short")
    block = np.frombuffer(data, np.uint8, rows * cols * channels).reshape(rows, cols, channels)
    return np.cumsum(block, axis=1, dtype=np.uint8) if predictor == 2 else block


@dataclass
class Layout:
    """How a page is stored: channels, compression, predictor, and rows of a strip or the side of square tiles (0: strips)."""

    channels: int = 1
    compression: int = NONE
    predictor: int = 1
    rows_per_strip: int = 256
    tile: int = 0


def write_tiff(pages: list[np.ndarray], layout: Layout) -> bytes:
    """Little-endian TIFF of pages (rows x columns x channels, 8 bits)."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for page in pages:
        h, w, c = page.shape
        blocks = []
        if layout.tile:
            t = layout.tile
            padded = np.zeros((-(-h // t) * t, -(-w // t) * t, c), np.uint8)
            padded[:h, :w] = page
            blocks = [_encode(padded[y : y + t, x : x + t], layout.compression, layout.predictor) for y in range(0, h, t) for x in range(0, w, t)]
        else:
            blocks = [_encode(page[y : y + layout.rows_per_strip], layout.compression, layout.predictor) for y in range(0, h, layout.rows_per_strip)]
        offsets = []
        for b in blocks:
            offsets.append(len(out))
            out += b
            out += b"\0" * (len(out) % 2)
        counts = [len(b) for b in blocks]
        tags: list[tuple[int, int, list[int]]] = [(WIDTH, 4, [w]), (LENGTH, 4, [h]), (BITS, 3, [8] * c), (COMPRESSION, 3, [layout.compression]), (PHOTOMETRIC, 3, [2 if c >= 3 else 1]), (SAMPLES, 3, [c]), (PREDICTOR, 3, [layout.predictor])]
        tags += [(TILE_WIDTH, 4, [layout.tile]), (TILE_LENGTH, 4, [layout.tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if layout.tile else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [layout.rows_per_strip]), (STRIP_COUNTS, 4, counts)]
        entries = []
        for tag, kind, values in sorted(tags):
            packed = struct.pack(f"<{len(values)}{'HI'[kind == 4]}", *values)
            if len(packed) > 4:
                place = len(out)
                out += packed
                out += b"\0" * (len(out) % 2)
                packed = struct.pack("<I", place)
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + packed.ljust(4, b"\0"))
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def read_tiff(data: bytes) -> Iterator[tuple[dict, np.ndarray]]:
    """(tags, samples) of each page, following the chain of directories; raises ValueError for what isn't TIFF."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("directories form a ring or lie outside")
        seen.add(at)
        tags: dict[int, list] = {}
        n = struct.unpack_from(order + "H", data, at)[0]
        for i in range(n):
            e = at + 2 + 12 * i
            tag, kind, count = struct.unpack_from(order + "HHI", data, e)
            size = TYPE_SIZE.get(kind, 0) * count
            place = e + 8 if size <= 4 else struct.unpack_from(order + "I", data, e + 8)[0]
            if kind in (1, 3, 4):
                tags[tag] = list(struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", data, place))
        yield tags, _page(data, tags)
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def _page(data: bytes, tags: dict[int, list]) -> np.ndarray:
    one = lambda tag, default=None: tags.get(tag, [default])[0]
    w, h, c = one(WIDTH), one(LENGTH), one(SAMPLES, 1)
    if not w or not h or any(b != 8 for b in tags.get(BITS, [1])):
        raise ValueError("only pages of 8-bit samples can be read")
    compression, predictor = one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if compression not in EXPANSION:
        raise ValueError(f"compression {compression} isn't supported")
    if predictor not in (1, 2):
        raise ValueError(f"predictor {predictor} isn't supported")
    if one(PLANAR, 1) != 1 and c > 1:
        raise ValueError("samples in planes of their own aren't supported")
    if one(FILL_ORDER, 1) != 1:
        raise ValueError("reversed bits aren't supported")
    tiled = TILE_OFFSETS in tags
    if tiled and not (one(TILE_WIDTH) and one(TILE_LENGTH)) or not one(ROWS_PER_STRIP, 1):
        raise ValueError("strips or tiles without size")
    held = sum(min(n, len(data)) for n in tags.get(TILE_COUNTS if tiled else STRIP_COUNTS, []))
    if w * h * c > held * EXPANSION[compression]:
        raise ValueError("the page is larger than its strips or tiles can hold")
    if tiled and one(TILE_WIDTH) * one(TILE_LENGTH) * c > len(data) * EXPANSION[compression]:
        raise ValueError("a tile is larger than the file can hold")
    out = np.empty((h, w, c), np.uint8)
    if TILE_OFFSETS in tags:
        tw, tl = one(TILE_WIDTH), one(TILE_LENGTH)
        places = [(y, x) for y in range(0, h, tl) for x in range(0, w, tw)]
        for (y, x), o, n in zip(places, tags[TILE_OFFSETS], tags[TILE_COUNTS], strict=True):
            out[y : y + tl, x : x + tw] = _decode(data[o : o + n], compression, predictor, tl, tw, c)[: h - y, : w - x]
    else:
        step = min(one(ROWS_PER_STRIP, h), h)
        for y, o, n in zip(range(0, h, step), tags[STRIP_OFFSETS], tags[STRIP_COUNTS], strict=True):
            out[y : y + step] = _decode(data[o : o + n], compression, predictor, min(step, h - y), w, c)
    return out


# --- payloads of text -------------------------------------------------------------------------------------------------

UNIT = 192
#: Rows of a page; longer payloads go on over further pages.
PAGE_ROWS = 1024


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 with spaces appended up to a positive multiple of UNIT, and the bytes before that."""
    raw = (text or "").encode()
    return raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" "), len(raw)


def layout_of(payload: bytes) -> Layout:
    """A layout that depends on the payload alone: all of the reader's branches occur, and equal payloads give equal files."""
    d = hashlib.sha256(payload).digest()
    compression = (NONE, LZW, DEFLATE, PACKBITS)[d[0] % 4]
    return Layout(channels=1 if d[1] & 1 else 3, compression=compression, predictor=2 if compression in (LZW, DEFLATE) and d[2] & 1 else 1, rows_per_strip=64, tile=64 if d[3] & 1 and len(payload) >= 64 * UNIT else 0)


def store_payload(payload: bytes) -> bytes:
    layout = layout_of(payload)
    image = np.frombuffer(payload, np.uint8).reshape(-1, UNIT // layout.channels, layout.channels)
    return write_tiff([image[y : y + PAGE_ROWS] for y in range(0, len(image), PAGE_ROWS)], layout)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n, size, media = [], 0, []
            while at + len(n) < batch.num_rows and size < 8 << 20:
                payload, raw = payload_of(batch.column(1)[at + len(n)].as_py())
                n.append(raw)
                media.append(store_payload(payload))
                size += len(payload)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(n)), pa.array(n, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])
            at += len(n)


def page_features(samples: np.ndarray) -> dict:
    """Integer statistics of a page's samples, and their counts in 16 equal bins."""
    flat = samples.ravel()
    hist = np.bincount(flat, minlength=256)
    value = np.arange(256)
    return {"sum": int((hist * value).sum()), "squares": int((hist * value * value).sum()), "low": int(flat.min()), "high": int(flat.max()), "bins": hist.reshape(16, 16).sum(axis=1).tolist()}


PAGE_FIELDS = [("id", pa.int64()), ("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("tiled", pa.bool_()), ("sum", pa.int64()), ("squares", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("bins", pa.list_(pa.int64())), ("samples", pa.binary()), ("error", pa.string()), ("media_bytes", pa.int64()), ("media_sha256", pa.string())]
PAGE_SCHEMA = "id long, page int, width int, height int, channels int, compression int, predictor int, tiled boolean, sum long, squares long, low int, high int, bins array<long>, samples binary, error string, media_bytes long, media_sha256 string"


def tiff_pages(media: DataFrame, id_col: str, media_col: str, carry: str | None = None) -> DataFrame:
    """One row per page of each file, with its samples, in the order of its directories; a file's rows follow one another. A null, empty or broken file
    gives its readable pages and one row with page null and the error. carry names a column of longs that each row repeats.

    Rows that repeat an id come out repeatedly. Pages pass in batches of some MB; one page is in memory whole.
    """
    schema = pa.schema([*PAGE_FIELDS, ("carried", pa.int64())])

    def rows_of(key: int | None, data: bytes | None, carried: int | None) -> Iterator[dict]:
        own = {"id": key, "carried": carried, "media_bytes": None if data is None else len(data), "media_sha256": None if data is None else hashlib.sha256(data).hexdigest(), "error": None}
        try:
            for k, (tags, page) in enumerate(read_tiff(data or b"")):
                yield own | {"page": k, "width": page.shape[1], "height": page.shape[0], "channels": page.shape[2], "compression": tags.get(COMPRESSION, [NONE])[0], "predictor": tags.get(PREDICTOR, [1])[0], "tiled": TILE_OFFSETS in tags, "samples": page.tobytes()} | page_features(page)
        except (ValueError, struct.error, zlib.error, IndexError, TypeError, KeyError) as e:
            yield own | {"error": str(e) or type(e).__name__}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for key, data, carried in zip(*(batch.column(i) for i in range(3)), strict=True):
                for row in rows_of(key.as_py(), data.as_py(), carried.as_py()):
                    found.append(row)
                    size += len(row.get("samples") or b"")
                    if size > 8 << 20 or len(found) >= 2000:
                        yield pa.RecordBatch.from_pylist(found, schema)
                        found, size = [], 0
        if found:
            yield pa.RecordBatch.from_pylist(found, schema)

    carried = F.col(carry) if carry else F.lit(None)
    return media.select(F.col(id_col).cast("long"), F.col(media_col), carried.cast("long")).mapInArrow(run, PAGE_SCHEMA + ", carried long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Page rows of files, one file after another -> a row for each file: digests of its samples in order of pages."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    now: dict | None = None
    out: list[tuple] = []

    def closed(f: dict) -> tuple:
        return f["id"], f["n"], f["size"], f["sha"].hexdigest(), zlib.crc32(f["tail"]), f["media"], f["media_sha"], "|".join(f["feats"])

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            if r["error"] is not None:
                raise ValueError(f"stored file of {r['id']}: {r['error']}")
            if r["page"] == 0:
                if now:
                    out.append(closed(now))
                now = {"id": r["id"], "n": r["carried"], "size": 0, "sha": hashlib.sha256(), "tail": b"", "media": r["media_bytes"], "media_sha": r["media_sha256"], "feats": []}
            assert now is not None
            part = r["samples"]
            now["sha"].update(part)
            now["size"] += len(part)
            now["tail"] = (now["tail"] + part[-16:])[-16:]
            now["feats"].append(f"{r['width']}x{r['height']}x{r['channels']}:{r['sum']}:{r['squares']}:{r['low']}-{r['high']}:" + ",".join(map(str, r["bins"])))
        if len(out) >= 2000:
            yield made(out)
            out = []
    if now:
        out.append(closed(now))
    if out:
        yield made(out)


def stored_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text as a TIFF file. A null text is empty; rows that repeat an id come out repeatedly."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_stored, "doc_id long, n_bytes long, media binary")


def digests_of(stored: DataFrame) -> DataFrame:
    """A row for each stored file, from the rows of its pages. The file is one row of one task, so its pages arrive together and in order."""
    pages = tiff_pages(stored, "doc_id", "media", carry="n_bytes")
    return pages.mapInArrow(_digests, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op7_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents as a TIFF file, and what its pages say when read back."""
    return digests_of(cut(stored_documents(table(spark, sf_dir, "documents")), "media"))
