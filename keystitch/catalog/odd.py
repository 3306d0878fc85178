"""The directory job over odd files (X7): what it writes, row by row, and what
one bad file does to the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as X
from ..functions.exprs import base_name
from ..job import enrich_directory
from ..session import scratch_path
from ..sinks.staged import read_manifest, read_outputs
from ..sources.files import list_feeds
from .registry import register

_BUILT: dict = {}

_ROWS = """SELECT *, CASE o_orderstatus WHEN 'F' THEN 'clash' WHEN 'O' THEN 'flat'
  ELSE CASE o_orderkey % 3 WHEN 0 THEN 'ragged' WHEN 1 THEN 'stray' ELSE 'open' END END || '_' || (o_orderkey // 200000) AS stem FROM orders"""


def x7_dir(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = X.build_x7(spark, sf_dir, scratch_path(spark, "x7"))
    return _BUILT[key]


def x7_job(spark, sf_dir, out=None, times=1):
    """The job over the folder's files and a path that is not there, ``times``
    over as a replayed batch."""
    feeds = x7_dir(spark, sf_dir)
    paths = [f.path for f in list_feeds(spark, feeds, (".csv",))] + [f"{feeds}/gone.csv"]
    for _ in range(times):
        res = enrich_directory(spark, feeds, X.x3_reference(spark, sf_dir), X.x3_spec().with_targets(["Taxable_Amount"]),
                               out=out, run_id="r1", paths=paths)
    return res.report


_WRITTEN = f"""SELECT *, row_number() OVER (PARTITION BY stem ORDER BY o_orderkey) - 1 AS row_idx FROM ({_ROWS})"""


def _stem(col):
    return F.regexp_replace(col, r"_[0-9]+\.csv$", "")


@register("job_output_rows", f"""
SELECT stem, row_idx, CAST(o_orderkey AS VARCHAR) AS pnr, o_orderpriority AS sector, 's' || o_orderkey AS c_sheet, 'S' AS c_sheet2,
       'r' AS c_run_id, 'o' AS c_output, 'f' AS c_source_file, 'a' || chr(10) || o_orderkey AS c_break,
       CAST(o_totalprice AS VARCHAR) AS amount, '-1' AS amount2, o_totalprice AS taxable
FROM ({_WRITTEN}) WHERE o_orderstatus = 'F'
UNION ALL SELECT stem, row_idx, CAST(o_orderkey AS VARCHAR), o_orderpriority, NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(o_totalprice AS VARCHAR) || CASE WHEN o_orderkey % 8 = 1 THEN '"' ELSE '' END, NULL, o_totalprice
FROM ({_WRITTEN}) WHERE o_orderstatus = 'O'""")
def job_output_rows(spark, sf_dir):
    """The written output of a batch that ran twice: every cell of the sound
    files once, in the order of the input, none of the failed ones (B1, B3, G1,
    R10, R14, H9)."""
    out = scratch_path(spark, "odd-out")
    x7_job(spark, sf_dir, out, times=2)
    names = {12: ["pnr", "code", "sector", "c_sheet", "c_sheet2", "c_run_id", "c_output", "c_source_file", "c_break", "amount", "amount2", "taxable"],
             5: ["pnr", "code", "sector", "amount", "taxable"]}
    both = None
    for columns, rows in read_outputs(spark, out, "r1"):
        part = rows.toDF(*names[len(columns)], "stem", "__ks_sheet", "row_idx").drop("code", "__ks_sheet")
        both = part if both is None else both.unionByName(part, allowMissingColumns=True)
    return both.withColumns({"taxable": F.col("taxable").cast("double"), "stem": _stem("stem")})


@register("job_output_folder", f"""
SELECT 'r1' AS run_id, stem, CAST(NULL AS VARCHAR) AS sheet, count(*) AS rows, CASE o_orderstatus WHEN 'F' THEN 12 ELSE 5 END AS columns
FROM ({_ROWS}) WHERE o_orderstatus <> 'P' GROUP BY stem, o_orderstatus""")
def job_output_folder(spark, sf_dir):
    """The whole output folder read with one call, files of clashing columns
    in it, beside what the run's manifest says of each output (B2)."""
    out = scratch_path(spark, "odd-out")
    x7_job(spark, sf_dir, out)
    rows = spark.read.schema("cell string").option("header", True).option("multiLine", True).option("escape", '"').csv(out)
    per = rows.groupBy("run_id", "output", "sheet").agg(F.count("*").alias("rows"))
    known = read_manifest(spark, out, "r1").select("output", F.size("columns").alias("columns"), F.col("rows").alias("known"))
    both = per.join(known, "output").where("rows = known")
    return both.select("run_id", _stem("output").alias("stem"), "sheet", "rows", "columns")


@register("job_isolation", f"""
SELECT stem || '.csv' AS name, CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN o_orderstatus <> 'P' THEN count(*) END AS rows, CASE WHEN o_orderstatus <> 'P' THEN count(*) END AS matched,
       CASE WHEN stem LIKE 'open%' THEN 'a quoted cell is not closed' WHEN o_orderstatus = 'P' THEN 'a row has more fields than the header''s 4' END AS reason
FROM ({_ROWS}) GROUP BY stem, o_orderstatus
UNION ALL SELECT 'gone.csv', 'failed', NULL, NULL, 'does not exist'""")
def job_isolation(spark, sf_dir):
    """Per-file status: a ragged file, stray quotes that make too many cells, a
    quoted cell without end and a vanished path fail alone (A2, A9, H2, R23, R24)."""
    return x7_job(spark, sf_dir).select(base_name(F.col("file")).alias("name"), "status", "rows", "matched", "reason")
