"""Incremental processing.

``enrich_incremental`` is the recurring job as a Structured Streaming query:
the file source lists new feed files (paths and sizes only — content is
pruned, so files of any size are fine, H6) and its checkpoint is the
process-once ledger; each micro-batch runs the batch directory job on exactly
its new files. ``trigger(availableNow=True)`` makes every run drain what has
arrived and stop, so any scheduler can call it; the calendar is the caller's.

``foreachBatch`` is at-least-once: a replayed batch rewrites the same
``run_id=<batch_id>`` partitions, under output names stamped with the batch's
latest file modification time, through dynamic partition overwrite, so the
output holds each batch exactly once (H9).

``enrich_stream`` is the pure streaming form for feeds that arrive as rows (a
stream-static left join against the first-per-key reference; stateless).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..job import REPORT_SCHEMA, enrich_directory
from ..operators.enrich import SharedReference, enrich, first_reference, prepare
from ..plans.headers import check_reference, plan_layout
from ..session import scratch_path
from ..spec import EnrichSpec
from .lease import AlreadyRunning, Lease


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _guard(spark: SparkSession, name: str | None) -> None:
    if name and any(q.name == name for q in spark.streams.active):
        raise AlreadyRunning(f"query {name!r} is still running")


def enrich_incremental(spark: SparkSession, directory: str, reference: DataFrame, spec: EnrichSpec,
                       out: str, checkpoint: str, *, report: str | None = None, archive: str | None = None,
                       name: str | None = None, fmt: str = "csv", available_now: bool = True,
                       interval: str | None = None, kept: str | None = None, lease_seconds: float = 600.0) -> StreamingQuery:
    """Start the incremental job; every new CSV/xlsx file is enriched once.

    ``archive`` moves processed files there (``cleanSource=archive``; Spark
    moves a file one batch after it was processed, under its full original
    path, H10). Reports go to ``report`` (default ``out + '_report'``) as one
    parquet partition per batch. A lease in the checkpoint folder, held until
    the query ends, keeps a second run out, of whatever session or application
    (:class:`AlreadyRunning`). ``kept`` is a folder for the first-per-key
    reference, which is then brought up to date instead of ranked in every
    batch (:mod:`..operators.kept`)."""
    _guard(spark, name)
    lease = Lease(spark, f"{checkpoint.rstrip('/')}_lease/run", lease_seconds).acquire().keep()
    try:
        return _start(spark, directory, reference, spec, out, checkpoint, lease, report=report, archive=archive, name=name, fmt=fmt,
                      available_now=available_now, interval=interval, kept=kept)
    except BaseException:
        lease.release()
        raise


def _start(spark, directory, reference, spec, out, checkpoint, lease, *, report, archive, name, fmt, available_now, interval, kept) -> StreamingQuery:
    report = report or out.rstrip("/") + "_report"
    exts = [e.lstrip(".") for e in spec.extensions if e.lower() in (".csv", ".xlsx")]
    # one glob level (H14): never list the folder itself, which may hold output
    # partitions; both cases of each extension, globs are case-sensitive
    pattern = "{" + ",".join(sorted({f"*.{e.lower()}" for e in exts} | {f"*.{e.upper()}" for e in exts})) + "}"
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.load(f"{directory.rstrip('/')}/{pattern}").select("path", "length")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]   # this batch's new file names
        if not paths:
            return
        lease.renew()   # raises where another run took over
        res = enrich_directory(spark, directory, reference, spec, out, run_id=str(batch_id), paths=paths,
                               fmt=fmt, kept=kept)
        (res.report.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(report))

    w = files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "1 day")
    query = w.start()

    def done():
        try:
            query.awaitTermination()
        except Exception:  # noqa: BLE001 - the query's owner sees it
            pass
        lease.release()
    query._ks_done = threading.Thread(target=done, daemon=True)
    query._ks_done.start()
    return query


def run_once(spark: SparkSession, *args, **kwargs) -> StreamingQuery:
    """Start an availableNow run and wait for it to finish."""
    q = enrich_incremental(spark, *args, **kwargs)
    q.awaitTermination()
    q._ks_done.join()   # the lease is free again
    if q.exception():
        raise q.exception()
    return q


def read_reports(spark: SparkSession, report: str) -> DataFrame:
    schema = T.StructType(REPORT_SCHEMA.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(report)


def enrich_stream(feed: DataFrame, reference: DataFrame, spec: EnrichSpec, *, flag: str | None = None) -> DataFrame:
    """Streaming feed rows enriched against a static reference (J4): a
    stateless stream-static left join. The first-per-key reference, pruned to
    what the feed lacks, is written once to the shared scratch folder; a
    micro-batch reads that table and ranks nothing. It holds the reference as
    of the start of the stream."""
    plan = plan_layout(feed.columns, spec)
    if plan.passthrough:
        return feed
    missing = [col for col, _ in plan.missing]
    check_reference(reference.columns, plan.keys, missing, spec.order_by)
    prep = prepare(feed, reference.schema, spec, plan)
    spark = feed.sparkSession
    path = scratch_path(spark, "first-per-key")
    first_reference(reference, spec, prep.ref_exprs, missing, reduce_reference=False).write.parquet(path)
    shared = SharedReference(spark.read.parquet(path), tuple(missing))
    return enrich(feed, reference, spec, flag=flag, plan=plan, shared=shared, prepared=prep)
