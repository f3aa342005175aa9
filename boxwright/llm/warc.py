"""Content-addressed WARC archive.

write_archive() splits each record into its exact header bytes and its payload. Payloads go once each into a store keyed by
SHA-256 (computed by the writer, computed again and compared by the reader); headers go into a table of their own with the digest
that they refer to. read_records() joins both and gives the original records back byte by byte, verified against the
digests and lengths that the headers state. export_warc() writes the same records as plain .warc files.

Of records with equal payloads, the one with the largest id holds the payload (a response); the others are revisits, which
carry a reference and no body, as WARC has it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import cut, new_path, shuffles_removed, table

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body = batch.column(2).fill_null("").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map(len, body), pa.int64()), pa.array([hashlib.sha256(x).digest() for x in body], pa.binary()), pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in body])],
            names=["page_id", "url", "payload_bytes", "sha256", "sha1"],
        )


def headers(row: dict) -> str:
    """The exact header of a record: WARC fields, a blank line, and (with a body or not) the HTTP header that belongs to it."""
    http = HTTP
    revisit = row["refers_to"] is not None
    size = len(http) + (0 if revisit else row["payload_bytes"])
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{row['page_id']}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{row['sha1']}"),
        ("WARC-Payload-Length", str(row["payload_bytes"])),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>")] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(size)),
    ]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + http


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [headers(r).encode() for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), batch.column(5), pa.array(heads, pa.binary())], names=["page_id", "sha256", "refers_to", "header"])


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", min_bytes: int = 0, path: str | None = None) -> str:
    """Write `headers` and `payloads` below a folder of the shared store; returns the folder.

    A null body is an empty payload. Payloads of fewer than min_bytes bytes are never shared. Rows without id are left out; rows that
    repeat an id are records of their own, and one of those with the largest id is the response. Other columns are ignored.
    """
    path = path or new_path(pages.sparkSession, "warc")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(body_col).alias("html")).where("page_id is not null")
    named = src.mapInArrow(_digests, "page_id long, url string, payload_bytes long, sha256 binary, sha1 string")
    holder = named.groupBy("sha256").agg(F.max("page_id").alias("holder"))
    joined = named.join(holder, "sha256")
    share = (F.col("payload_bytes") >= min_bytes) & (F.col("holder") != F.col("page_id"))
    rows = joined.select("page_id", "url", "payload_bytes", "sha1", "sha256", F.when(share, F.col("holder")).alias("refers_to"))
    with shuffles_removed(pages.sparkSession):
        rows.mapInArrow(_headers, "page_id long, sha256 binary, refers_to long, header binary").write.option("compression", "zstd").parquet(f"{path}/headers")
    held = pages.sparkSession.read.parquet(f"{path}/headers").where("refers_to is null").groupBy("sha256").agg(F.max("page_id").alias("page_id"))
    bodies = src.select("page_id", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload")).join(held, "page_id")
    once = bodies.where(F.unhex(F.sha2("payload", 256)) == F.col("sha256"))  # an id that repeats has bodies of other digests too
    with shuffles_removed(pages.sparkSession):
        once.dropDuplicates(["page_id", "sha256"]).select("sha256", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    return path


FIELD = re.compile(rb"^([A-Za-z-]+): (.*?)\r$", re.M)


def parse_header(header: bytes) -> tuple[dict[str, str], int]:
    """WARC fields, and where the HTTP header begins."""
    end = header.index(b"\r\n\r\n")
    return {k.decode().lower(): v.decode() for k, v in FIELD.findall(header[: end + 1])}, end + 4


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of the store -> size and SHA-1 of the bytes as read, each held against the digest that it is stored under."""
    for batch in batches:
        body = batch.column(1).to_pylist()
        for sha, x in zip(batch.column(0).to_pylist(), body, strict=True):
            if hashlib.sha256(x).digest() != sha:
                raise ValueError(f"payload {sha.hex()} is altered")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, body), pa.int64()), pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in body])], names=["sha256", "n", "sha1"])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records (header, sha256, n, sha1 of the payload read back) -> what they are, each header held against its payload."""
    for batch in batches:
        out = []
        for header, n, sha1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            f, body = parse_header(header)
            name, revisit = f["warc-record-id"], f["warc-type"] == "revisit"
            if n is None:
                raise ValueError(f"{name}: payload is missing")
            if sha1 != f["warc-payload-digest"][5:] or n != int(f["warc-payload-length"]):
                raise ValueError(f"{name}: digest or length of the payload differs")
            if len(header) - body + (0 if revisit else n) != int(f["content-length"]):
                raise ValueError(f"{name}: length differs")
            out.append((int(name[10:-1]), n, sha1, f["warc-type"], int(f["warc-refers-to"][10:-1]) if revisit else None))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_records(spark: SparkSession, path: str, bodies_of_revisits: bool = False) -> DataFrame:
    """(page_id, header, payload, sha256) of every record, put together from headers and payloads by digest: the records as they were written. With
    bodies_of_revisits, revisits get the payload they refer to."""
    heads, store = (spark.read.parquet(f"{path}/{x}") for x in ("headers", "payloads"))
    if bodies_of_revisits:
        return heads.join(store, "sha256", "left").select("page_id", "header", "payload", "sha256")
    # responses and payloads meet one to one (one to few below min_bytes): the digest of a revisit never hits this join
    full = heads.where("refers_to is null").join(store, "sha256", "left").select("page_id", "header", "payload", "sha256")
    return full.unionByName(heads.where("refers_to is not null").select("page_id", "header", F.lit(None).cast("binary").alias("payload"), "sha256"))


def payload_facts(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, n, sha1) of every stored payload, taken from its bytes."""
    return spark.read.parquet(f"{path}/payloads").select("sha256", "payload").mapInArrow(_facts, "sha256 binary, n long, sha1 string").dropDuplicates(["sha256"])


def parse_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, responses and revisits alike from the payload that they
    name. Payloads are read once each; what moves to their records is a digest and a size, so a payload of very many records costs no more."""
    facts = cut(payload_facts(spark, path), "facts")  # its own exchange: Spark splits the records of one payload
    full = spark.read.parquet(f"{path}/headers").join(facts, "sha256", "left").select("header", "n", "sha1")
    return full.mapInArrow(_parsed, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def export_warc(records: DataFrame, path: str) -> None:
    """Plain .warc files: header, body, blank lines; revisits (without payload) end after their HTTP header. Written by Spark's text sink, byte for byte."""
    body = F.concat(F.col("header"), F.coalesce("payload", F.lit(b"")))
    records.select(body.cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def op9_warc_content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of a content-addressed archive, and what the archive says when read back."""
    return parse_records(spark, write_archive(table(spark, sf_dir, "pages"), min_bytes=0))


OP9_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages where page_id is not null),
h as (select page_id, octet_length(b)::bigint as n, sha256(b) as s,
        from_hex(sha1(b)) as d from p),
x as (select *, list_transform(range(0, 20), lambda i: ('0x' || substr(hex(d), 2 * i + 1, 2))::int) as y,
        max(page_id) over (partition by s) as top from h)
select page_id, n as payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((y[1 + (k * 5) // 8] * 256 + coalesce(y[2 + (k * 5) // 8], 0)) >> (11 - (k * 5) % 8)) & 31)::int, 1)), 'string_agg', '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from x
"""
