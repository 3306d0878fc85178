"""Incremental queries (J1-J4, B4): the X1 feed arrives as files in two drops;
two availableNow runs must give the batch result, each file once."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixtures as X
from ..functions.exprs import c
from ..plans.headers import plan_layout
from ..session import scratch_path
from ..sinks.writers import read_csv_output, write_csv
from ..sources.files import hadoop_glob, hadoop_mkdirs, hadoop_rename
from ..operators.enrich import enrich, prepare
from ..operators.kept import KeptReference
from ..sources.reference import read_reference
from ..streaming.incremental import enrich_stream, read_reports, run_once
from ..streaming.lease import AlreadyRunning, Lease
from .frames import JOIN_SQL, TARGETS_SQL
from .registry import register

def _drops():
    return [F.col("Sector") != "N", F.col("Sector") == "N"]


def _drop_files(spark, df, fmt, staging, target, prefix):
    """Write ``df`` with Spark, then move its part files into ``target`` so
    each file appears there complete."""
    if fmt == "csv":
        write_csv(df, staging)
    else:
        df.write.mode("overwrite").parquet(staging)
    for i, part in enumerate(hadoop_glob(spark, f"{staging}/part-*")):
        hadoop_rename(spark, part, f"{target}/{prefix}_{i:05d}.{fmt}")


def _typed(df, names):
    types = {"Airline PNR/Prov. Booking": "bigint", " AIRLINE code ": "int", "Qty": "double",
             "l_partkey": "bigint", "l_suppkey": "bigint", "Taxable_Amount": "double",
             "NonTaxable_Amount": "double", "CGST": "double", "Booking Date": "timestamp_ntz",
             "Invoice_Number": "bigint"}
    return df.select(*[c(n).cast(types[n]).alias(n) if n in types else c(n) for n in names])


def incremental_run(spark, sf_dir):
    """Two drops of CSV feed files, two availableNow runs, then a third run
    with nothing new. Returns (output path, report path, enriched columns, folder)."""
    root = scratch_path(spark, "incremental")
    inbox, out, ckpt, archive = f"{root}/inbox", f"{root}/out", f"{root}/ckpt", f"{root}/archive"
    hadoop_mkdirs(spark, inbox)
    feed = X.x1_feed(spark, sf_dir)
    ref = X.x1_reference(spark, sf_dir)
    spec = X.x1_spec(ref)
    for i, cond in enumerate(_drops()):
        _drop_files(spark, feed.filter(cond), "csv", f"{root}/staging{i}", inbox, f"drop{i}")
        run_once(spark, inbox, ref, spec, out, ckpt, archive=archive, name=f"ks_incremental_{uuid.uuid4().hex}")
    run_once(spark, inbox, ref, spec, out, ckpt, archive=archive, name=f"ks_incremental_{uuid.uuid4().hex}")
    plan = plan_layout(feed.columns, spec)
    cols = list(feed.columns) + list(plan.appended)
    return out, out + "_report", cols, root


@register("incremental_enrich", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL}")
def incremental_enrich(spark, sf_dir):
    """New feed files enriched by a file-stream + foreachBatch job (J1, J4):
    the union of both runs equals the batch result."""
    out, _, cols, _ = incremental_run(spark, sf_dir)
    return _typed(read_csv_output(spark, out, cols), cols)


@register("incremental_once", f"""
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows, 'success' AS status
FROM ({X.X1_FEED_SQL}) f WHERE "Sector" <> 'N'
UNION ALL SELECT 1, count(*), 'success' FROM ({X.X1_FEED_SQL}) f WHERE "Sector" = 'N'""")
def incremental_once(spark, sf_dir):
    """Each file is processed once (J2): rows per batch from the per-batch
    reports; the third run found nothing new and wrote no batch."""
    _, report, _, _ = incremental_run(spark, sf_dir)
    r = read_reports(spark, report)
    return r.groupBy("batch_id", "status").agg(F.sum("rows").alias("rows"))


@register("incremental_archive", f"""SELECT f.*, CASE WHEN "Sector" <> 'N' THEN true END AS archived FROM ({X.X1_FEED_SQL}) f""")
def incremental_archive(spark, sf_dir):
    """Rows of all feed files, moved or not (B4): none is lost by archiving,
    and the first drop's files are in the archive once a later batch has run."""
    _, _, cols, root = incremental_run(spark, sf_dir)
    names = list(X.x1_feed(spark, sf_dir).columns)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    files = spark.read.schema(schema).option("header", True).option("escape", '"').option("recursiveFileLookup", True)
    found = files.csv(f"{root}/archive").withColumn("moved", F.lit(True))
    if hadoop_glob(spark, f"{root}/inbox/*.csv"):
        found = found.unionByName(files.csv(f"{root}/inbox").withColumn("moved", F.lit(False)))
    return _typed(found, names + ["moved"]).withColumn("archived", F.when(F.col("Sector") != "N", F.col("moved"))).drop("moved")


@register("stream_static_enrich", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL}")
def stream_static_enrich(spark, sf_dir):
    """Feed rows arriving as parquet files, enriched by a stateless
    stream-static left join (J4); two availableNow runs."""
    root = scratch_path(spark, "stream-static")
    inbox, out, ckpt = f"{root}/inbox", f"{root}/out", f"{root}/ckpt"
    hadoop_mkdirs(spark, inbox)
    feed = X.x1_feed(spark, sf_dir)
    ref = X.x1_reference(spark, sf_dir)
    spec = X.x1_spec(ref)
    for i, cond in enumerate(_drops()):
        _drop_files(spark, feed.filter(cond), "parquet", f"{root}/staging{i}", inbox, f"drop{i}")
        stream = spark.readStream.schema(feed.schema).parquet(inbox)
        q = (enrich_stream(stream, ref, spec).writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()
    return spark.read.parquet(out)


@register("kept_reference", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL}")
def kept_reference(spark, sf_dir):
    """A first-per-key reference kept between batches (F2, J1): built from one
    part of the reference's files, merged with the files that came later, and
    joined without ranking or shuffling it."""
    root = scratch_path(spark, "kept")
    ref, feed = X.x1_reference(spark, sf_dir), X.x1_feed(spark, sf_dir)
    spec = X.x1_spec(ref)
    plan = plan_layout(feed.columns, spec)
    kept = KeptReference(f"{root}/table", buckets=16)
    late = F.col("Invoice_Number") % 2 == 0
    shared = None
    for part in (~late, late):
        ref.where(part).write.mode("append").parquet(f"{root}/reference")
        now = read_reference(spark, f"{root}/reference")
        prep = prepare(feed, now.schema, spec, plan)
        shared = kept.shared(now, spec, prep.ref_exprs, [n for n, _ in plan.missing])
    return enrich(feed, now, spec, plan=plan, shared=shared, prepared=prep)


@register("overlap_guard", f"""
WITH n AS (SELECT count(*) AS n FROM ({X.X1_FEED_SQL}) f WHERE "Sector" = 'N')
SELECT 1 AS step, 'ran' AS outcome, n AS rows FROM n
UNION ALL SELECT 2, 'refused', 0
UNION ALL SELECT 3, 'ran after a dead run', n FROM n""")
def overlap_guard(spark, sf_dir):
    """Runs over the same checkpoint (J3): one that has ended lets the next
    one in, one in force elsewhere keeps it out, one that died is taken over."""
    root = scratch_path(spark, "lease")
    feed, ref = X.x1_feed(spark, sf_dir), X.x1_reference(spark, sf_dir)
    spec = X.x1_spec(ref)
    inbox, out, ckpt = f"{root}/inbox", f"{root}/out", f"{root}/ckpt"
    hadoop_mkdirs(spark, inbox)
    rows = []

    def drop(i):
        _drop_files(spark, feed.where(F.col("Sector") == "N"), "csv", f"{root}/staging{i}", inbox, f"drop{i}")
    drop(0)
    run_once(spark, inbox, ref, spec, out, ckpt)
    rows.append((1, "ran"))
    drop(1)
    other = Lease(spark, f"{ckpt}_lease/run", seconds=3600, owner="another application").acquire()
    try:
        run_once(spark, inbox, ref, spec, out, ckpt)
        rows.append((2, "ran"))
    except AlreadyRunning:
        rows.append((2, "refused"))
    other.release()
    Lease(spark, f"{ckpt}_lease/run", seconds=-1, owner="a run that died").acquire()
    run_once(spark, inbox, ref, spec, out, ckpt)
    rows.append((3, "ran after a dead run"))
    steps = spark.createDataFrame(rows, "step int, outcome string")
    done = read_reports(spark, out + "_report").groupBy((F.col("batch_id") * 2 + 1).cast("int").alias("step")).agg(F.sum("rows").alias("rows"))
    return steps.join(done, "step", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
