"""Feed discovery, validation and header probing.

Listing and headers are metadata: the driver lists one directory level through
the Hadoop FileSystem (so zero-byte files, which Spark's file index skips, are
still seen and reported — H5) and reads only the first record of each CSV, in
parallel and up to a stated number of bytes. No data rows pass through the
driver.
"""

from __future__ import annotations

import csv as _pycsv
import io
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import DEFAULT_EXTENSIONS


@dataclass(frozen=True)
class FeedFile:
    path: str
    length: int
    ext: str
    ext_rank: int
    modified: int = 0   # milliseconds since the epoch


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _ext(name: str) -> str:
    base = name.rsplit("/", 1)[-1]
    stem, dot, ext = base.rpartition(".")
    return ("." + ext).lower() if dot and stem else ""


def list_feeds(spark: SparkSession, directory: str,
               extensions: Sequence[str] = DEFAULT_EXTENSIONS) -> list[FeedFile]:
    """Non-recursive listing of supported files, ordered by extension list then
    name (A1, D5). Extensions compare case-insensitively."""
    fs, jpath = _fs(spark, directory)
    if not fs.exists(jpath):
        return []
    exts = [e.lower() for e in extensions]
    out = []
    for st in fs.listStatus(jpath):
        if not st.isFile():
            continue
        p = st.getPath().toString()
        e = _ext(p)
        if e in exts:
            out.append(FeedFile(p, int(st.getLen()), e, exts.index(e), int(st.getModificationTime())))
    return sorted(out, key=lambda f: (f.ext_rank, f.path))


def stat_feeds(spark: SparkSession, paths: Sequence[str]) -> tuple[list[FeedFile], list[tuple[str, str]]]:
    """Requested paths as feed files, and (path, reason) of those that are not
    readable files now. An empty file is listed: the job reports it itself."""
    found, failures = [], []
    for p, why in validate(spark, paths):
        if why is None or why == "empty file":
            fs, jp = _fs(spark, p)
            st = fs.getFileStatus(jp)
            found.append(FeedFile(p, int(st.getLen()), _ext(p), 0, int(st.getModificationTime())))
        else:
            failures.append((p, why))
    return found, failures


def discover(spark: SparkSession, directory: str, extensions: Sequence[str] = DEFAULT_EXTENSIONS) -> DataFrame:
    """Supported files of one folder level as a DataFrame: ``path, name, ext,
    length, ext_rank``. Spark's file index lists them (content is pruned); it
    leaves out empty files, which the folder's own listing adds."""
    exts = [e.lower() for e in extensions]
    listed = list_feeds(spark, directory, extensions)
    files = spark.createDataFrame([(f.path, f.length) for f in listed if f.length == 0], "path string, length bigint")
    if any(f.length > 0 for f in listed):
        # a glob of files, never the folder: sub-folders may hold output partitions
        either = lambda e: "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in e)
        glob = "{" + ",".join(f"*{either(e)}" for e in exts) + "}"
        found = spark.read.format("binaryFile").load(f"{directory.rstrip('/')}/{glob}").select("path", "length")
        files = found.unionByName(files)
    named = files.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
    named = named.withColumn("ext", F.lower(F.regexp_extract("name", r"^.+?(\.[^.]*)?$", 1)))
    named = named.withColumn("ext_rank", (F.array_position(F.array(*[F.lit(e) for e in exts]), F.col("ext")) - 1).cast("int"))
    return named.filter("ext_rank >= 0").select("path", "name", "ext", "length", "ext_rank")


def validate(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, str | None]]:
    """(path, reason) for each requested path; reason None means valid (A9):
    it exists, is a file, is readable and non-empty."""
    out = []
    for p in paths:
        try:
            fs, jpath = _fs(spark, p)
            if not fs.exists(jpath):
                out.append((p, "does not exist"))
                continue
            st = fs.getFileStatus(jpath)
            if not st.isFile():
                out.append((p, "not a file"))
            elif st.getLen() == 0:
                out.append((p, "empty file"))
            else:
                out.append((p, None))
        except Exception as e:  # noqa: BLE001 - reported, not raised
            out.append((p, f"unreadable: {type(e).__name__}"))
    return out


#: A header record longer than this fails its file.
MAX_HEADER_BYTES = 1 << 20


@dataclass(frozen=True)
class Header:
    """First record of a CSV: its raw labels, or why there are none. ``lead``
    counts the white-space-only (not empty) lines before it."""
    labels: tuple[str, ...] | None
    lead: int = 0
    reason: str | None = None


def parse_header(text: str, delimiter: str = ",", quote: str = '"') -> list[str]:
    """Labels of the first record of ``text``: quoted line breaks belong to it."""
    return next(_pycsv.reader(io.StringIO(text, newline=""), delimiter=delimiter, quotechar=quote, doublequote=True))


def _first_record(text: str, at_end: bool, delimiter: str, quote: str) -> tuple[Header | None, bool]:
    """(header, complete): incomplete when the record may go on after ``text``.
    Lines of nothing but spaces and tabs are no records, as for the job's reader."""
    lead, at = 0, 0
    while at < len(text):
        end = min((i for i in (text.find("\n", at), text.find("\r", at)) if i >= 0), default=len(text))
        line = text[at:end]
        if line.strip(" \t"):
            break
        if end == len(text):
            at = end
            break
        lead += bool(line)
        at = end + 1
    if at >= len(text):
        return Header(None, lead, "no header line (empty file)"), at_end
    reader = _pycsv.reader(io.StringIO(text[at:], newline=""), delimiter=delimiter, quotechar=quote, doublequote=True)
    labels = next(reader)
    body = text[at:]
    used = "".join(io.StringIO(body, newline="").readlines()[:reader.line_num])
    complete = at_end or (len(used) < len(body)) or used.endswith("\n")
    return Header(tuple(labels), lead), complete


def decode_header(data: bytes, at_end: bool, encoding: str, delimiter: str, quote: str = '"') -> tuple[Header | None, bool]:
    """(header, complete) from a file's first bytes."""
    import codecs
    text = codecs.getincrementaldecoder(encoding)("strict").decode(data, at_end).removeprefix("\ufeff")
    return _first_record(text, at_end, delimiter, quote)


def read_header(spark: SparkSession, path: str, encoding: str = "UTF-8", delimiter: str = ",",
                quote: str = '"') -> Header:
    """First record of a CSV file, read up to :data:`MAX_HEADER_BYTES`."""
    try:
        fs, jpath = _fs(spark, path)
        size = 1 << 16
        while True:
            stream = fs.open(jpath)
            try:
                data = bytes(stream.readNBytes(size))
            finally:
                stream.close()
            at_end = len(data) < size
            header, complete = decode_header(data, at_end, encoding, delimiter, quote)
            if complete:
                return header
            if size >= MAX_HEADER_BYTES:
                return Header(None, 0, f"no complete header in the first {MAX_HEADER_BYTES} bytes")
            size = MAX_HEADER_BYTES
    except _pycsv.Error as e:
        return Header(None, 0, f"no complete header: {e}")
    except UnicodeDecodeError:
        return Header(None, 0, f"header is not {encoding} text")
    except Exception as e:  # noqa: BLE001 - this file's failure, reported as such
        return Header(None, 0, f"unreadable: {type(e).__name__}")


def probe_headers(spark: SparkSession, paths: Sequence[str], threads: int = 16, encoding: str = "UTF-8",
                  delimiter: str = ",") -> dict[str, Header]:
    """First record of each file (A4b); a file without one has the reason."""
    if not paths:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(paths)))) as pool:
        found = list(pool.map(lambda p: read_header(spark, p, encoding, delimiter), paths))
    return dict(zip(paths, found))


def hadoop_write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file (fixtures: header-only, zero-byte, ignored types)."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        data = text.encode("utf-8")
        if data:
            out.write(bytearray(data))
    finally:
        out.close()


def hadoop_mkdirs(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def hadoop_delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def hadoop_rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, jsrc = _fs(spark, src)
    return bool(fs.rename(jsrc, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def hadoop_glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, jpath = _fs(spark, pattern)
    sts = fs.globStatus(jpath)
    return sorted(st.getPath().toString() for st in (sts or []))
