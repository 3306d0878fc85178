"""WARC writing and reading.

Writing: one record per page. Of records with equal payloads of at least
``min_revisit`` bytes the one with the largest page_id is a response, the others
are revisits of it (no payload, its id, digest and length in the header). The
records are written by Spark's text writer, whose line separator is the blank
line pair that ends a record, so files are committed by task, and a lost
executor's part is written again. Pages are not gathered by payload: the
largest page_id per digest is aggregated, and only digests of two rows or more
are joined back.

Reading, by boundary-chain verification: tasks search the bytes for the record
magic and emit each place as a candidate with the offset of its successor, as
its header tells. Pointer jumping from each file's start then keeps the
candidates that are reached; a magic inside a payload is not on the chain. Each
round doubles the reach and is two joins on (file, offset, successor). Headers
may be of any length. A file whose chain does not reach its end is an error.

Files hold about ``file_bytes`` (one record at least), so a task that reads one
has a bounded need. Defined results: null html is an empty payload; null url
and page_id give records without them; of repeated rows of the largest page_id
the one with the greatest url is the response, and wholly equal rows all are;
an empty table gives no records."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path
from .common import cut, small

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
_FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)")


def mark_revisits(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, digest, refers_to)``."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    # equal payloads: by a second, longer digest; only ids and digests are shuffled
    same = F.when(F.col("payload_bytes") >= min_revisit, F.sha2("payload", 256))
    rows = rows.withColumn("same", same)
    groups = cut(rows.where("same is not null").groupBy("same").agg(
        F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("top")).where("n > 1").select("same", "top"))
    # pages too short to be revisits match nothing: each has a key of its own, so that they spread where the join is shuffled
    alone = F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string"))
    joined = rows.withColumn("same", F.coalesce("same", alone)).join(small(groups), "same", "left")
    mine = F.col("top").isNull() | (F.struct("page_id", "url").eqNullSafe(F.col("top")))
    return joined.select("page_id", "url", "payload", "payload_bytes", "digest", mine.alias("own"),
                         F.when(~mine, F.col("top.page_id")).alias("refers_to"))


def write(pages: DataFrame, path: str, min_revisit: int = 1000, file_bytes: int = 16 << 20,
          date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes ``pages`` (page_id, url, html) as WARC files in the folder ``path``."""
    rows = mark_revisits(pages, min_revisit)
    mean = pages.agg(F.avg(F.octet_length("html") + 400)).first()[0] or 1.0
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    body = F.when(F.col("own"), F.col("payload")).otherwise("")
    head = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.when(F.col("own"), "response").otherwise("revisit")),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(F.col("own"), "").otherwise(line("WARC-Refers-To", urn(F.col("refers_to")))),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"), F.lit("Content-Length: "), F.octet_length(body).cast("string"))
    (rows.select(F.concat(head, F.lit(END), body).alias("value")).write.option("lineSep", END)
     .option("maxRecordsPerFile", max(1, int(file_bytes / mean))).text(path))


def records_at(content: bytes):
    """Candidates of a file: ``(offset, successor, type, page_id, refers_to,
    payload_bytes, digest)``. The payload is looked at only where the successor
    is the file's end or another magic. Magics before the same blank line share
    what is read of it, so the search is linear in the file's length."""
    at, head, fields, after, told = content.find(MAGIC), -1, {}, 0, None
    while at >= 0:
        if head < at:
            head = content.find(b"\r\n\r\n", at)
            if head < 0:
                return
            # the last of each name, with its place: a later magic has those behind it
            fields = {m[1].lower(): (m.start(), m[2]) for m in _FIELD.finditer(content, at + len(MAGIC), head)}
            size = fields.get(b"content-length", (0, b""))[1]
            after, told = 0, None
            if size.isdigit() and len(size) < 16:
                start, n = head + 4, int(size)
                if content[start + n:start + n + 4] == b"\r\n\r\n" and (start + n + 4 == len(content) or content.startswith(MAGIC, start + n + 4)):
                    after, told = start + n + 4, (n, hashlib.sha1(memoryview(content)[start:start + n]).hexdigest())
        mine = lambda name: fields[name][1] if name in fields and fields[name][0] > at else None
        if told and mine(b"content-length") is not None:
            kind = (mine(b"warc-type") or b"").decode("ascii", "replace")
            length, digest = told
            if kind == "revisit":
                digest = (mine(b"warc-payload-digest") or b"").decode("ascii", "replace").removeprefix("sha1:")
                size = mine(b"x-payload-length") or b""
                length = int(size) if size.isdigit() else 0
            yield at, after, kind, _page(mine(b"warc-record-id")), _page(mine(b"warc-refers-to")), length, digest
        at = content.find(MAGIC, at + 1)


def _page(urn: bytes | None) -> str | None:
    m = re.fullmatch(rb"<urn:page:(.+)>", urn or b"")
    return m[1].decode("utf-8", "replace") if m else None


def candidates(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """Candidate records of the uncompressed archives in ``path``, and for each
    file its end: a row without a type that is its own successor."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("path", "content")
    schema = ("file string, offset long, successor long, record_type string, page_id string, refers_to string, "
              "payload_bytes long, payload_digest string")

    def run(batches):
        import pyarrow as pa
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = ["file", "offset", "successor", "record_type", "page_id", "refers_to", "payload_bytes", "payload_digest"]
        for b in batches:
            for p, c in zip(b.column("path"), b.column("content")):
                content = c.as_py()
                rows = [(p.as_py(), *r) for r in records_at(content)]
                rows.append((p.as_py(), len(content), len(content), None, None, None, None, None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(cols, types)], names=names)
    return files.mapInArrow(run, schema)   # a partition's files fill spark.sql.files.maxPartitionBytes at most


def _jump(t: DataFrame) -> DataFrame:
    """One round: what the reached point to is reached, and pointers double. A
    chain's last candidates keep their pointer (to the file's end)."""
    ahead = t.select("file", F.col("offset").alias("to"), F.col("to").alias("beyond"))
    hits = t.where("hit").select("file", F.col("to").alias("offset"), F.lit(True).alias("now")).distinct()
    return (t.join(hits, ["file", "offset"], "left").join(ahead, ["file", "to"], "left")
            .select("file", "offset", F.coalesce("beyond", "to").alias("to"), (F.col("hit") | F.col("now").isNotNull()).alias("hit")))


def reachable(found: DataFrame) -> DataFrame:
    """``(file, offset)`` of the candidates on the chain from their file's start."""
    t = cut(found.select("file", "offset", F.col("successor").alias("to"), (F.col("offset") == 0).alias("hit")))
    n, last = t.where("hit").count(), -1
    while n != last:
        t = cut(_jump(t))
        n, last = t.where("hit").count(), n
    return t.where("hit").select("file", "offset")


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row per verified record of the archives in ``path``."""
    found = cut(candidates(spark, path))
    reached = cut(reachable(found))
    broken = found.where("record_type is null").join(reached, ["file", "offset"], "left_anti").select("file", "offset").take(5)
    if broken:
        raise ValueError("records do not reach the file's end: " + ", ".join(f"{f} ({n} bytes)" for f, n in broken))
    return found.where("record_type is not null").join(reached, ["file", "offset"], "left_semi").select(
        F.col("page_id").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"))


def round_trip(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """Writes the pages' archives to the shared scratch folder and reads them."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, min_revisit)
    return read(pages.sparkSession, path, pages.schema["page_id"].dataType.simpleString())
