"""Files as tables: listings, copies, split archives."""

from __future__ import annotations

import io
import os
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from boxwright.functions.text import suffix


def listing(spark: SparkSession, path: str, extensions: list[str] | None = None, recursive: bool = True) -> DataFrame:
    """Paths below a folder, without their contents being read."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length")
    return x.where(suffix(F.col("path")).isin([e.lower() for e in extensions])) if extensions else x


def copy_files(plan: DataFrame, symlink: bool = False, overwrite: bool = False) -> DataFrame:
    """Runs a plan (src, dst, action) on mounted folders; returns (dst, did): copied, linked, or skipped for other actions and, without
    overwrite, for what is there. A file appears whole or not at all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import shutil

        for pdf in batches:
            did = []
            for src, dst, action in zip(pdf["src"], pdf["dst"], pdf["action"], strict=True):
                if action != "copy" or (not overwrite and os.path.lexists(dst)):
                    did.append("skipped")
                    continue
                os.makedirs(os.path.dirname(dst), exist_ok=True)
                part = f"{dst}.part{os.getpid()}"
                if symlink:
                    os.symlink(os.path.abspath(src), part)
                else:
                    shutil.copy2(src, part)
                os.replace(part, dst)
                did.append("linked" if symlink else "copied")
            yield pd.DataFrame({"dst": pdf["dst"], "did": did})

    return plan.select("src", "dst", "action").mapInPandas(run, "dst string, did string")


class _Parts(io.RawIOBase):
    """Files read as one after the other."""

    def __init__(self, paths: list[str]):
        self.paths, self.sizes, self.at = paths, [os.path.getsize(p) for p in paths], 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, to: int, whence: int = 0) -> int:
        self.at = to if whence == 0 else self.at + to if whence == 1 else sum(self.sizes) + to
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, b) -> int:
        start = 0
        for p, n in zip(self.paths, self.sizes, strict=True):
            if self.at < start + n:
                with open(p, "rb") as f:
                    f.seek(self.at - start)
                    got = f.read(min(len(b), start + n - self.at))
                b[: len(got)] = got
                self.at += len(got)
                return len(got)
            start += n
        return 0


def tar_members(parts: list[str]) -> list[dict]:
    """Members of a tar that is split over files in the order of their names: (path, kind, offset, size, mode, mtime, link)."""
    kinds = {tarfile.REGTYPE: "file", tarfile.AREGTYPE: "file", tarfile.DIRTYPE: "dir", tarfile.SYMTYPE: "symlink", tarfile.LNKTYPE: "hardlink"}
    with tarfile.open(fileobj=io.BufferedReader(_Parts(sorted(parts, key=os.path.basename))), mode="r:") as t:
        return [{"path": m.name, "kind": kinds.get(m.type, "other"), "offset": m.offset_data, "size": m.size, "mode": m.mode, "mtime": int(m.mtime), "link": m.linkname} for m in t]


def extract_tar(spark: SparkSession, parts: list[str], out: str, strip: int = 0) -> DataFrame:
    """Extracts in parallel by offset: (path, kind, did). Modes and times are kept, folders made. Links follow when all files are there; a hard
    link is to the file that the archive names. Members or links that would leave the folder are refused, files of the right size stay, other
    kinds are left out and say so. Parts and out are on a folder that all executors mount."""
    from boxwright.functions.text import safe_path, strip_components

    tasks = spark.createDataFrame(tar_members(parts), "path string, kind string, offset long, size long, mode int, mtime long, link string")
    tasks = tasks.withColumn("safe", safe_path(F.col("path"))).withColumn("to", strip_components(F.col("path"), strip)).where("to is not null").withColumn("link_to", strip_components(F.col("link"), strip))
    names = sorted(parts, key=os.path.basename)
    root = os.path.realpath(out)

    def inside(p: str) -> bool:
        return os.path.realpath(p).startswith(root + os.sep)

    def made(r, whole: _Parts) -> str:
        dst = os.path.join(out, r.to)
        if not r.safe or not inside(os.path.dirname(dst) + os.sep + "x"):
            return "refused"
        if r.kind == "dir":
            os.makedirs(dst, exist_ok=True)
            return "made"
        if r.kind == "other":
            return "left out"
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        if r.kind == "symlink":
            if r.link.startswith("/") or not inside(os.path.join(os.path.dirname(dst), r.link)):
                return "refused"
            if not os.path.lexists(dst):
                os.symlink(r.link, dst)
            return "linked"
        if r.kind == "hardlink":
            src = os.path.join(out, r.link_to or "")
            if not r.link_to or not inside(src) or not os.path.exists(src):
                return "refused"
            if not os.path.exists(dst):
                os.link(src, dst)
            return "linked"
        if os.path.exists(dst) and os.path.getsize(dst) == r.size:
            return "kept"
        whole.seek(r.offset)
        with open(f"{dst}.tmp", "wb") as f:
            left = r.size
            while left:
                b = bytearray(min(left, 4 << 20))
                n = whole.readinto(b)
                f.write(b[:n])
                left -= n
        os.chmod(f"{dst}.tmp", r.mode & 0o777)
        os.utime(f"{dst}.tmp", (r.mtime, r.mtime))
        os.replace(f"{dst}.tmp", dst)
        return "written"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = _Parts(names)
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "kind": pdf["kind"], "did": [made(r, whole) for r in pdf.itertuples()]})

    n = max(1, spark.sparkContext.defaultParallelism)
    schema = "path string, kind string, did string"
    links = tasks.kind.isin("symlink", "hardlink")
    files = tasks.where(~links).repartition(n, "path").mapInPandas(run, schema).persist()
    files.count()  # links come after what they point to
    return files.unionByName(tasks.where(links).repartition(n, "path").mapInPandas(run, schema))


def materialise(pages: DataFrame, out: str, key: str = "deck_id", name: str = "name", data: str = "bytes") -> DataFrame:
    """Writes the files of each deck below out/deck: (deck, n_files, did). A deck is written into a folder of its own, renamed when whole and marked
    by a file .complete; one that is marked is kept. A deck is the work of one task, and its pages pass one by one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import shutil

        deck, n, part = None, 0, ""

        def close() -> pd.DataFrame:
            final = os.path.join(out, str(deck))
            if n < 0:
                return pd.DataFrame({"deck": [str(deck)], "n_files": [0], "did": ["kept"]})
            open(os.path.join(part, ".complete"), "w").close()
            shutil.rmtree(final, ignore_errors=True)
            os.replace(part, final)
            return pd.DataFrame({"deck": [str(deck)], "n_files": [n], "did": ["written"]})

        for pdf in batches:
            for k, file, body in zip(pdf["k"], pdf["f"], pdf["b"], strict=True):
                if k != deck:
                    if deck is not None:
                        yield close()
                    deck, n, part = k, 0, os.path.join(out, f".{k}.{os.getpid()}.tmp")
                    if os.path.exists(os.path.join(out, str(k), ".complete")):
                        n = -1
                    else:
                        shutil.rmtree(part, ignore_errors=True)
                        os.makedirs(part)
                if n >= 0:
                    with open(os.path.join(part, os.path.basename(file)), "wb") as f:
                        f.write(body or b"")
                    n += 1
        if deck is not None:
            yield close()

    rows = pages.select(F.col(key).cast("string").alias("k"), F.col(name).alias("f"), F.col(data).alias("b")).where("k is not null and f is not null")
    return rows.repartition("k").sortWithinPartitions("k", "f").mapInPandas(run, "deck string, n_files long, did string")


def image_struct(df: DataFrame, column: str) -> DataFrame:
    """column as STRUCT<bytes, path>, whether it holds a path, bytes or such a struct; pixels aren't decoded."""
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    if kind.startswith("struct"):
        names = {f.name for f in df.schema[column].dataType.fields}
        field = lambda n, t: (c[n] if n in names else F.lit(None)).cast(t)
        data, path = field("bytes", "binary"), field("path", "string")
    else:
        data, path = (c, F.lit(None).cast("string")) if kind == "binary" else (F.lit(None).cast("binary"), c.cast("string"))
    return df.withColumn(column, F.when(c.isNotNull(), F.struct(data.alias("bytes"), path.alias("path"))))


def extract_with_system_tar(archive: str, out: str, keep: bool = True) -> str:
    """Runs the system's tar, with pigz where it is installed; deletes the archive afterwards unless it is to be kept. Returns the program."""
    import shutil
    import subprocess

    os.makedirs(out, exist_ok=True)
    fast = shutil.which("pigz") if archive.endswith((".gz", ".tgz")) else None
    subprocess.run(["tar", *(["--use-compress-program", fast] if fast else []), "-xf", archive, "-C", out], check=True)
    if not keep:
        os.remove(archive)
    return "pigz" if fast else "tar"


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Parquet shards with the split that each file's name says, validation, valid and dev as val."""
    base = F.col("_metadata.file_name")
    name = F.coalesce(F.nullif(F.regexp_extract(base, r"^(.+)-\d+-of-\d+\.parquet$", 1), F.lit("")), F.nullif(F.regexp_extract(base, r"^([^-]+)-.*\.parquet$", 1), F.lit("")))
    return spark.read.parquet(path).withColumn("split", F.when(name.isin("validation", "valid", "dev"), "val").otherwise(name))


def zip_folder(folder: str, out: str) -> int:
    """Deflated at the highest level, names relative to the folder; returns the number of files."""
    n = 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        for d, _, names in sorted(os.walk(folder)):
            for x in sorted(names):
                z.write(os.path.join(d, x), os.path.relpath(os.path.join(d, x), folder))
                n += 1
    return n


def split_of(shard: str) -> str | None:
    """Split of a shard's file name: before -00000-of-00001, else before the first dash; validation, valid and dev are val."""
    import re

    base = os.path.basename(shard)
    m = re.match(r"^(.+)-\d+-of-\d+\.parquet$", base) or re.match(r"^([^-]+)-.*\.parquet$", base)
    return {"validation": "val", "valid": "val", "dev": "val"}.get(m[1], m[1]) if m else None


# Which files each kind of download takes.
ANNOTATIONS, ARCHIVES, SHARDS = ["*.jsonl", "**/*.jsonl"], ["*.tar.gz", "**/*.tar.gz"], ["**/*.parquet"]


def download_patterns(mode: str = "all", allow: list[str] | None = None) -> list[str]:
    """File patterns of a download: what is asked for explicitly, else what the mode (metadata, images, parquet, all) stands for."""
    return allow if allow is not None else {"metadata": ANNOTATIONS, "images": ARCHIVES, "parquet": SHARDS}.get(mode, ANNOTATIONS + ARCHIVES)


def chosen_files(names: list[str], allow: list[str], ignore: list[str] | None = None) -> list[str]:
    """Names that match a pattern and none to ignore; * also stands for slashes."""
    from fnmatch import fnmatch

    hit = lambda n, patterns: any(fnmatch(n, p) for p in patterns or [])
    return [n for n in names if hit(n, allow) and not hit(n, ignore)]
