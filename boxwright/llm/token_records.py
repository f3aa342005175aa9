"""Token ids as length-delimited binary records, with a separate offset index.

A record: length of the data (unsigned 64 bits, little-endian), masked CRC-32C of those 8 bytes (unsigned 32 bits), the
data, masked CRC-32C of the data, and one line feed that closes the record. Data are the row's id (signed 64 bits; the
smallest value stands for null) and its token ids as little-endian unsigned 16-bit integers where the vocabulary has at
most 65,536 entries, else 32-bit. Shards are raw files in ascending order of row ids; the index (doc_id, shard, offset,
length, start, n_tokens) is a table of its own, so that a shuffled read takes records by offset without walking files.

Executors write through Spark's own text sink (bytes as they are, the line feed as its separator), so files
reach any store that Spark writes to, under its commit protocol.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .chunks import ChunkTable
from .shared import cut, new_path, table
from .words import blocks, text_buffers
from .workers import kept, lean

HEADER = 12
FRAME = HEADER + 4 + 1
MASK_DELTA = 0xA282EAD8
#: Bytes of text for one shard; a longer text has a shard's rest for itself.
SHARD_TEXT_BYTES = 24 << 20
#: Bytes of strings whose checksums are computed together; one longer string is by itself.
CRC_BYTES = 1 << 19
#: Stands for a null id in a record.
NULL_ID = -(1 << 63)

_crc_tables = None


def _tables() -> np.ndarray:
    """16 tables of 256 entries for CRC-32C, reflected polynomial 0x82F63B78."""
    global _crc_tables
    if _crc_tables is None:
        t = np.zeros((16, 256), np.uint32)
        c = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0x82F63B78), c >> np.uint32(1))
        t[0] = c
        for k in range(1, 16):
            t[k] = t[0][t[k - 1] & 0xFF] ^ (t[k - 1] >> np.uint32(8))
        _crc_tables = t
    return _crc_tables


def _zeros_operator() -> np.ndarray:
    """Powers of the linear map that appends one zero byte, as 32x32 bit matrices kept as columns of uint32."""
    t = _tables()[0]
    one = np.array([t[(1 << i) & 0xFF] ^ ((1 << i) >> 8) for i in range(32)], np.uint64).astype(np.uint32)
    out = [one]
    for _ in range(47):
        out.append(_apply_vec(out[-1], out[-1]))
    return np.stack(out)


def _apply_vec(op: np.ndarray, v: np.ndarray) -> np.ndarray:
    r = np.zeros_like(v)
    for i in range(32):
        r ^= np.where((v >> np.uint32(i)) & np.uint32(1), op[i], np.uint32(0)).astype(np.uint32)
    return r


_ops = None


def _shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC state after n zero bytes, for arrays."""
    global _ops
    if _ops is None:
        _ops = _zeros_operator()
    crc, bit = crc.copy(), 0
    n = n.copy()
    while n.any():
        odd = (n & 1).astype(bool)
        if odd.any():
            crc[odd] = _apply_vec(_ops[bit], crc[odd])
        n >>= 1
        bit += 1
    return crc


def crc32c(parts: list[bytes] | list[memoryview]) -> np.ndarray:
    """CRC-32C of each string, CRC_BYTES of them at a time: the work takes some thirty bytes of memory for each byte."""
    if not parts:
        return np.zeros(0, np.uint32)
    offs = np.cumsum([0, *map(len, parts)])
    return np.concatenate([_crc32c(parts[i:j]) for i, j in blocks(offs, CRC_BYTES)])


def _crc32c(parts: list[bytes] | list[memoryview]) -> np.ndarray:
    """Works through 256-byte pieces of all strings together, then joins the pieces' remainders."""
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    lanes = 256
    count = np.maximum(1, -(-size // lanes))
    head = count * lanes - size  # zero bytes in front: they don't change a zero state
    total = int(count.sum())
    buf = np.zeros(total * lanes, np.uint8)
    ends = np.cumsum(count) * lanes
    flat = np.frombuffer(b"".join(parts), np.uint8)
    if len(flat):
        pos = np.repeat(ends - size - (np.cumsum(size) - size), size) + np.arange(len(flat))
        buf[pos] = flat
    rows = buf.reshape(total, lanes)
    t = _tables()
    state = np.zeros(total, np.uint32)
    for i in range(0, lanes, 16):
        x = rows[:, i : i + 16]
        acc = np.zeros(total, np.uint32)
        for j in range(16):
            b = x[:, j]
            if j < 4:
                b = b ^ ((state >> np.uint32(8 * j)) & np.uint32(0xFF)).astype(np.uint8)
            acc ^= t[15 - j][b]
        state = acc
    # piece p of string s still has (last - p) * lanes zero bytes to come
    owner = np.repeat(np.arange(len(parts)), count)
    after = (np.cumsum(count)[owner] - 1 - np.arange(total)) * lanes
    state = _shift(state, after)
    plain = np.bitwise_xor.reduceat(state, np.cumsum(count) - count)
    init = _shift(np.full(len(parts), 0xFFFFFFFF, np.uint32), size)
    return plain ^ init ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def frame(datas: list[bytes]) -> list[bytes]:
    """Records without their closing line feed, which the sink writes."""
    lens = [len(x).to_bytes(8, "little") for x in datas]
    head, tail = masked(crc32c(lens)).astype("<u4"), masked(crc32c(datas)).astype("<u4")
    return [b"".join((n, h.tobytes(), d, t.tobytes())) for n, h, d, t in zip(lens, head, datas, tail, strict=True)]


def unframe(buf: memoryview) -> list[tuple[int, memoryview]]:
    """(offset, data) of each record of a shard; raises where a length, checksum or end is wrong."""
    at, out, heads, want_head, want_tail = 0, [], [], [], []
    while at < len(buf):
        n = int.from_bytes(buf[at : at + 8], "little")
        end = at + HEADER + n + 4
        if end >= len(buf) or buf[end] != 10:
            raise ValueError(f"record at {at} is cut short")
        heads.append(bytes(buf[at : at + 8]))
        want_head.append(int.from_bytes(buf[at + 8 : at + 12], "little"))
        want_tail.append(int.from_bytes(buf[end - 4 : end], "little"))
        out.append((at, buf[at + HEADER : at + HEADER + n]))
        at = end + 1
    if (masked(crc32c(heads)) != np.array(want_head, np.uint32)).any():
        raise ValueError("checksum of a length is wrong")
    if (masked(crc32c([d for _, d in out])) != np.array(want_tail, np.uint32)).any():
        raise ValueError("checksum of data is wrong")
    return out


#: Lead bytes of characters of two and three bytes among which are white space and marks that some library may take for it.
ODD_TWO = np.isin(np.arange(256), [0xC2])
ODD_THREE = np.isin(np.arange(256), [0xE1, 0xE2, 0xE3, 0xEF])
#: Bytes that may start, or end, a character next to a cut.
PLAIN_NEXT = (np.arange(256) > 32) & (np.arange(256) != 127) & ~ODD_TWO & ~ODD_THREE
PLAIN_PREV = (np.arange(256) > 32) & (np.arange(256) != 127)


class ChunkEncoder(ChunkTable):
    """Ids of texts by way of distinct chunks, so that a word that occurs often is encoded by the tokenizers library once.

    A text is cut before every single space, and around every single line feed, between two characters that surely aren't
    white space. There a byte-level pre-tokenizer always starts a new token, and no added token's string has white
    space, so the ids of the chunks in a row are those of the text. Chunks are known by a 64-bit hash.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        super().__init__("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        config = json.loads(self.tok.to_str())
        self.plain = config["pre_tokenizer"]["type"] == "ByteLevel" and config["model"]["type"] == "BPE" and not config["model"].get("ignore_merges")
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in a byte-level vocabulary
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.word = re.compile(r"( ?[^\W\d_]+)([.,;:!?*$%&#)]*)")
        self.tails: dict[str, list[int]] = {"": []}

    def _piece(self, s: str) -> list[int]:
        return [t.id for t in self.tok.model.tokenize(s.encode().decode("latin-1").translate(self.letters))]

    def _chunk(self, s: str) -> list[int]:
        m = self.word.fullmatch(s) if self.plain else None
        if m and m[1].lstrip(" ").isalpha():  # one run of letters and one of signs: exactly two pre-tokens
            if m[2] not in self.tails:
                self.tails[m[2]] = self._piece(m[2])
            return self._piece(m[1]) + self.tails[m[2]]
        return self.tok.encode(s, add_special_tokens=False).ids

    @staticmethod
    def cuts(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Start of every chunk."""
        at = np.flatnonzero((raw == 32) | (raw == 10))
        edge = np.zeros(len(raw) + 1, bool)
        edge[offs] = True
        at = at[(at > 0) & (at < len(raw) - 1)]
        at = at[~(edge[at] | edge[at + 1]) & PLAIN_NEXT[raw[at + 1]] & PLAIN_PREV[raw[at - 1]]]
        wide = np.flatnonzero(raw[at - 1] >= 128)  # such a character's lead byte is one to three bytes further back
        bad = wide[ODD_TWO[raw[np.maximum(at[wide] - 2, 0)]] | ODD_THREE[raw[np.maximum(at[wide] - 3, 0)]]]
        at = np.delete(at, bad)
        mark = np.zeros(len(raw) + 1, bool)
        mark[at] = True
        mark[at[raw[at] == 10] + 1] = True
        mark[offs[:-1][np.diff(offs) > 0]] = True
        return np.flatnonzero(mark[:-1])

    def encode_new(self, chunks: list[str]) -> list[list[int]]:
        return [self._chunk(c) for c in chunks]

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, n+1 offsets into them)."""
        return self.encode_chunks(raw, self.cuts(raw, offs), offs)


def encoder(path: str) -> ChunkEncoder:
    return kept(("chunks", path), lambda: ChunkEncoder(path))


def _framed(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        width = len(end)
        for batch in batches:
            raw, offs = text_buffers(batch.column(1))
            docs = batch.column(0).fill_null(NULL_ID).to_numpy().astype("<i8")
            for i, j in blocks(offs, 1 << 20):
                ids, bounds = enc.encode(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                flat, bounds = ids.tobytes(), (bounds * width).tolist()
                datas = [docs[r].tobytes() + flat[bounds[r - i] : bounds[r - i + 1]] + end for r in range(i, j)]
                yield pa.RecordBatch.from_arrays([pa.array(frame(datas), pa.binary())], names=["record"])

    return run


def _walk(dtype: str):
    """Shards (path, content) -> a row for each record, checksums verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                shard = batch.column(0)[r].as_py()
                records = unframe(memoryview(batch.column(1)[r].as_buffer()))
                for i in range(0, len(records), 4096):
                    part = records[i : i + 4096]
                    doc = np.array([int.from_bytes(d[:8], "little", signed=True) for _, d in part], np.int64)
                    ids = [np.frombuffer(d[8:], dtype) for _, d in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc, mask=doc == NULL_ID), pa.array([shard] * len(part), pa.string()), pa.array([o for o, _ in part], pa.int64()), pa.array([len(d) for _, d in part], pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())],
                        names=["doc_id", "shard", "offset", "length", "n_tokens", "ids_crc32"],
                    )

    return run


def write_records(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, shard_text_bytes: int = SHARD_TEXT_BYTES) -> str:
    """Write every row as one record, in ascending order of its id; returns the folder of shards.

    Rows that repeat an id stand next to one another in any order; a null id comes first. A null or empty text is the end id
    alone. An empty table writes shards without records. Other columns are ignored.
    """
    path = path or new_path(docs.sparkSession, "records")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = F.col("doc_id").asc_nulls_first()
    ordered = src.repartitionByRange(max(1, -(-total // shard_text_bytes)), order).sortWithinPartitions(order)
    rows = ordered.mapInArrow(lean(_framed(tokenizer, end_id), keeps=True), "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)
    return path


def build_index(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Walk the shards once: (doc_id, shard, offset, length, n_tokens, ids_crc32, start), as a table in the shared folder.

    start counts the ids of all records before: of earlier shards (one total per shard goes through one task) and
    earlier in the shard.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", "([^/]*)$", 1).alias("shard"), "content")
    rows = cut(files.mapInArrow(lean(_walk(encoder(tokenizer).dtype)), "doc_id long, shard string, offset long, length long, n_tokens long, ids_crc32 long"), "records-index")
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    sums = sums.select("shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    within = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return rows.withColumn("within", within).join(sums, "shard").withColumn("start", F.col("base") + F.col("within")).drop("base", "within")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of the index rows given, taken by offset and length, without walking the shards' other records; order is that of no shard.

    Spark's reader hands over a shard as one value, so each shard that holds a wanted record is read once, whole; shards hold at most about
    SHARD_TEXT_BYTES of text, or one text. A reader with seeks takes the same offsets.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", "([^/]*)$", 1).alias("shard"), "content")
    wanted = index.select("shard", "doc_id", "offset", "length").groupBy("shard").agg(F.collect_list(F.struct("doc_id", "offset", "length")).alias("w"))
    dtype = encoder(tokenizer).dtype

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                buf = memoryview(batch.column(0)[r].as_buffer())
                rows = batch.column(1)[r].as_py()
                out = []
                for x in rows:
                    found = unframe(buf[x["offset"] : x["offset"] + FRAME + x["length"]])
                    out.append(np.frombuffer(found[0][1][8:], dtype).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([x["doc_id"] for x in rows], pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return files.join(wanted, "shard").select("content", "w").mapInArrow(lean(take), "doc_id long, ids array<long>")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    name = public_tokenizers.path("byte_bpe_50k.json")
    path = write_records(table(spark, sf_dir, "documents"), name, end_id=2)
    return build_index(spark, path, name).select("doc_id", "start", "n_tokens", "ids_crc32")
