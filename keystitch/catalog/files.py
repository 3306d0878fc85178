"""Queries over a CSV feed directory that Spark writes from `orders` (X3):
discovery, validation, layouts, scans, row order, types, sinks, the job and
its report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import fixtures as X
from ..functions.exprs import base_name, c, extension, output_ext, output_name, stem
from ..job import enrich_directory, run_summary
from ..operators.enrich import enrich
from ..plans.headers import NoKeyColumns, plan_layout, resolve_headers
from ..plans.layouts import plan_layouts
from ..plans.wide import csv_cells, file_types, typed, union_csv, union_types
from ..session import scratch_path
from ..sinks.writers import read_csv_output, write_csv
from ..sources.csv import csv_layouts, read_layout
from ..sources.files import discover, hadoop_delete, hadoop_mkdirs, list_feeds
from ..sources.headers import header_table, layout_headers, path_table
from ..sources.reference import read_reference
from ..spec import DEFAULT_EXTENSIONS
from .registry import register

_BUILT: dict = {}
RUN_TS = datetime(2024, 1, 2, 3, 4, 5, 123456)   # fixed so output names are reproducible
STAMP = "20240102030405123456"


def x3_dir(spark, sf_dir):
    """Build the X3 folder once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        root = scratch_path(spark, "x3")
        _BUILT[key] = (root, X.build_x3(spark, sf_dir, root))
    return _BUILT[key]


def _layouts(spark, sf_dir):
    root, feeds = x3_dir(spark, sf_dir)
    files = [f.path for f in list_feeds(spark, feeds, (".csv",)) if f.length > 0]
    return csv_layouts(spark, files)


def _name(col):
    return base_name(col).alias("name")


_NAMES = f"SELECT DISTINCT name, o_orderstatus AS status FROM ({X.X3_ROWS_SQL})"


@register("feed_discovery", f"""
SELECT name, '.csv' AS ext, 2 AS ext_rank, true AS non_empty FROM ({_NAMES})
UNION ALL SELECT 'header_only.csv', '.csv', 2, true
UNION ALL SELECT 'empty.csv', '.csv', 2, false""")
def feed_discovery(spark, sf_dir):
    """Supported files of one folder level; .txt and sub-folders are ignored."""
    _, feeds = x3_dir(spark, sf_dir)
    d = discover(spark, feeds, DEFAULT_EXTENSIONS)
    return d.select("name", "ext", "ext_rank", (F.col("length") > 0).alias("non_empty"))


def _headers(spark, sf_dir):
    """Header records of the folder's CSV files, read by tasks."""
    _, feeds = x3_dir(spark, sf_dir)
    return header_table(discover(spark, feeds, (".csv",)))


def _counted(sql):
    """The twin's rows with the number of data rows that each file holds."""
    return f"""SELECT l.*, coalesce(r.rows, 0) AS rows FROM ({sql}) l
LEFT JOIN (SELECT name, count(*) AS rows FROM ({X.X3_ROWS_SQL}) GROUP BY name) r ON l.name = r.name"""


def _with_rows(files, heads):
    """``files`` (a ``path`` column) beside the number of data rows that the
    scan of the files finds in each."""
    cells, _ = csv_cells(files.sparkSession, heads)
    rows = cells.groupBy(F.col("source_file").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return files.join(rows, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


@register("feed_validation", _counted(f"""
SELECT name, CAST(NULL AS VARCHAR) AS reason, true AS has_bytes FROM ({_NAMES})
UNION ALL SELECT 'header_only.csv', NULL, true UNION ALL SELECT 'empty.csv', 'empty file', false
UNION ALL SELECT 'missing.csv', 'does not exist', NULL UNION ALL SELECT 'archive', 'not a file', NULL"""))
def feed_validation(spark, sf_dir):
    """Exists / is a file / non-empty, for listed and requested paths (A9), and
    the data rows of each; tasks look at the files and scan them."""
    _, feeds = x3_dir(spark, sf_dir)
    paths = discover(spark, feeds, (".csv",)).select("path").union(path_table(spark, [f"{feeds}/missing.csv", f"{feeds}/archive"]))
    heads = header_table(paths)
    return _with_rows(heads, heads).select(_name(F.col("path")), "reason", (F.col("length") > 0).alias("has_bytes"), "rows")


_LAYOUT_SQL = f"""
SELECT name,
  CASE status WHEN 'F' THEN 'Airline PNR|Airline Code|Sector|Amount|Order Date|Unnamed: 5'
              WHEN 'O' THEN 'sector|Order Date|PNRNUMBER|airlinecode|Amount|Amount.1'
              ELSE 'Airline PNR|Airline Code|Amount' END AS labels,
  CASE status WHEN 'F' THEN 'Airline PNR|Airline Code|Sector|Amount|Order Date'
              WHEN 'O' THEN 'sector|Order Date|PNRNUMBER|airlinecode|Amount|Amount.1'
              ELSE 'Airline PNR|Airline Code|Amount' END AS kept,
  CASE status WHEN 'P' THEN NULL ELSE 'PNR_Number|Airline_Code|Travel_Sector' END AS key_combo
FROM ({_NAMES})
UNION ALL SELECT 'header_only.csv', 'Airline PNR|Airline Code|Sector|Amount', 'Airline PNR|Airline Code|Sector|Amount',
  'PNR_Number|Airline_Code|Travel_Sector'"""


def _layout_rows(spark, sf_dir):
    """Per file: labels, kept labels, key combination and data rows, as one plan."""
    heads = _headers(spark, sf_dir).where("names is not null")
    plan = plan_layouts(layout_headers(heads), X.x3_spec()).select(F.col("layout_id").alias("path"), F.array_join("keys", "|").alias("key_combo"))
    kept = F.transform("kept", lambda p: F.get(F.col("names"), p))
    files = heads.join(plan, "path").select("path", F.array_join("names", "|").alias("labels"), F.array_join(kept, "|").alias("kept"), "key_combo")
    return _with_rows(files, heads).select(_name(F.col("path")), "labels", "kept", "key_combo", "rows")


@register("csv_layouts", _counted(_LAYOUT_SQL))
def csv_layouts_q(spark, sf_dir):
    """Header labels per file (blank -> 'Unnamed: n', repeats -> '.1'), kept
    labels after dropping unnamed columns, detected key combination, data rows
    (A4b, A5, C3)."""
    return _layout_rows(spark, sf_dir)


@register("key_combo_detect", _counted(f"SELECT name, key_combo FROM ({_LAYOUT_SQL})"))
def key_combo_detect(spark, sf_dir):
    """First fully present key combination per file, NULL when none, beside
    the file's data rows (C3, R5)."""
    return _layout_rows(spark, sf_dir).select("name", "key_combo", "rows")


def _all_rows(spark, sf_dir, with_row_index=False):
    """Every data row of every layout: file name, PNR as bigint, Amount as double."""
    feeds = _layouts(spark, sf_dir)
    out = None
    for lay in feeds.layouts:
        df = read_layout(spark, lay, with_row_index=with_row_index)
        mapping = resolve_headers(lay.columns, X.x3_spec().aliases)
        pnr = next(k for k, v in mapping.items() if v == "PNR_Number")
        cols = [_name(F.col("source_file")), c(pnr).cast("bigint").alias("PNR_Number"),
                c("Amount").cast("double").alias("amount")]
        if with_row_index:
            cols.append("row_idx")
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df)
    return out


@register("csv_scan", f"""
SELECT name, o_orderkey AS PNR_Number, o_totalprice AS amount FROM ({X.X3_ROWS_SQL})""")
def csv_scan(spark, sf_dir):
    """All layouts read with positional string schemas, unioned (A2)."""
    return _all_rows(spark, sf_dir)


@register("row_index", f"""
SELECT name, o_orderkey AS PNR_Number, o_totalprice AS amount,
       row_number() OVER (PARTITION BY name ORDER BY o_orderkey) - 1 AS row_idx
FROM ({X.X3_ROWS_SQL})""")
def row_index(spark, sf_dir):
    """0-based row position within each file, without a global sort (G1)."""
    return _all_rows(spark, sf_dir, with_row_index=True)


_UNION_SQL = f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY o_orderkey) - 1 AS row_idx, strftime(o_orderdate, '%Y-%m-%d') AS day FROM ({X.X3_ROWS_SQL}))
SELECT name, row_idx, o_orderkey AS "Airline PNR", o_custkey AS "Airline Code", sector AS "Sector", o_totalprice AS "Amount", day AS "Order Date"
FROM r WHERE o_orderstatus = 'F'
UNION ALL BY NAME SELECT name, row_idx, sector, day AS "Order Date", o_orderkey AS "PNRNUMBER", o_custkey AS "airlinecode", o_totalprice AS "Amount", o_custkey AS "Amount.1"
FROM r WHERE o_orderstatus = 'O'
UNION ALL BY NAME SELECT name, row_idx, o_orderkey AS "Airline PNR", o_custkey AS "Airline Code", o_totalprice AS "Amount" FROM r WHERE o_orderstatus = 'P'"""


def _union(spark, sf_dir):
    """All layouts by name in one plan, cells as text."""
    return union_csv(spark, _headers(spark, sf_dir))


def _labels(df):
    return [n for n in df.columns if n not in ("source_file", "row_idx")]


@register("layout_union", f"SELECT * FROM ({_UNION_SQL})")
def layout_union(spark, sf_dir):
    """Files of different columns as one frame, by name (H1): one scan and a
    projection by data, whatever the number of layouts; typed (A8)."""
    df = _union(spark, sf_dir)
    return typed(df, _labels(df)).withColumn("name", base_name(F.col("source_file"))).drop("source_file")


@register("drop_unnamed", f"SELECT * EXCLUDE (row_idx) FROM ({_UNION_SQL})")
def drop_unnamed(spark, sf_dir):
    """The blank-header column is dropped; the rest keep their labels (A5), in all layouts."""
    df = _union(spark, sf_dir)
    kinds = {"Airline PNR": "bigint", "Airline Code": "bigint", "PNRNUMBER": "bigint", "airlinecode": "bigint", "Amount": "double", "Amount.1": "bigint"}
    return df.select(_name(F.col("source_file")), *[c(n).cast(kinds.get(n, "string")).alias(n) for n in _labels(df)])


@register("infer_types", f"SELECT * EXCLUDE (row_idx, name) FROM ({_UNION_SQL})")
def infer_types_q(spark, sf_dir):
    """Opt-in type inference over all layouts: one aggregate per (file, label)
    gives each file's types, their least common one is the column's (A8)."""
    df = _union(spark, sf_dir)
    return typed(df, _labels(df)).drop("source_file", "row_idx")


@register("feed_types", f"""
WITH u AS (SELECT * FROM ({_UNION_SQL})),
f AS (SELECT name, label, type, n FROM (
  SELECT name, unnest(['Airline PNR', 'Airline Code', 'Sector', 'Amount', 'Order Date', 'PNRNUMBER', 'airlinecode', 'Amount.1']) AS label,
         unnest(['bigint', 'bigint', 'string', 'double', 'string', 'bigint', 'bigint', 'bigint']) AS type,
         unnest([count("Airline PNR"), count("Airline Code"), count("Sector"), count("Amount"), count("Order Date"), count("PNRNUMBER"), count("airlinecode"), count("Amount.1")]) AS n
  FROM u GROUP BY name) WHERE n > 0)
SELECT f.*, max(type) OVER (PARTITION BY label) AS merged, count(*) OVER (PARTITION BY label) AS files FROM f""")
def feed_types(spark, sf_dir):
    """Each file's own type per label, and the type that holds all files' (A8)."""
    df = _union(spark, sf_dir)
    per = file_types(df, _labels(df))
    merged = union_types(per).withColumnRenamed("type", "merged")
    return per.join(merged, "label").select(_name(F.col("file")), "label", "type", "n", "merged", "files")


@register("csv_roundtrip", f"""
SELECT o_orderkey AS pnr, o_custkey AS code, sector, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS amount_1,
       CASE WHEN sector IS NULL THEN NULL ELSE o_totalprice END AS taxable,
       CASE WHEN sector IS NULL THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS booking
FROM ({X.X3_ROWS_SQL}) WHERE o_orderstatus <> 'P'""")
def csv_roundtrip(spark, sf_dir):
    """Every layout with keys, enriched, written as header CSV without index
    and read back (B1)."""
    ref, spec = X.x3_reference(spark, sf_dir), X.x3_spec()
    out = None
    for lay in _layouts(spark, sf_dir).layouts:
        try:
            plan = plan_layout(lay.columns, spec)
        except NoKeyColumns:
            continue
        enriched = enrich(read_layout(spark, lay).drop("source_file"), ref, spec, plan=plan)
        path = scratch_path(spark, "roundtrip")
        write_csv(enriched, path)
        back = read_csv_output(spark, path, enriched.columns)
        mapping = {v: k for k, v in resolve_headers(lay.columns, spec.aliases).items()}
        have = lambda n, kind: (c(n).cast(kind) if n in back.columns else F.lit(None).cast(kind))
        part = back.select(c(mapping["PNR_Number"]).cast("bigint").alias("pnr"), c(mapping["Airline_Code"]).cast("bigint").alias("code"),
                           c(mapping["Travel_Sector"]).alias("sector"), have("Amount", "double").alias("amount"), have("Order Date", "string").alias("day"),
                           have("Amount.1", "bigint").alias("amount_1"), have("Taxable_Amount", "double").alias("taxable"),
                           F.substring(c("Booking Date"), 1, 10).alias("booking"))
        out = part if out is None else out.unionByName(part)
    return out


@register("path_parts", f"""
SELECT name, regexp_replace(name, '\\.[^.]*$', '') AS stem, '.csv' AS ext, '.csv' AS output_ext, count(*) AS rows FROM ({X.X3_ROWS_SQL}) GROUP BY name""")
def path_parts(spark, sf_dir):
    """basename / stem / lower-case extension / output extension of each row's file (I4)."""
    path = F.col("source_file")
    return _union(spark, sf_dir).groupBy(_name(path), stem(path).alias("stem"), extension(path).alias("ext"),
                                         output_ext(path).alias("output_ext")).agg(F.count("*").alias("rows"))


@register("output_names", f"""
SELECT name, regexp_replace(name, '\\.[^.]*$', '') || '_{STAMP}.csv' AS output, count(*) AS rows FROM ({X.X3_ROWS_SQL}) GROUP BY name""")
def output_names_q(spark, sf_dir):
    """``{stem}_{YYYYMMDDHHMMSSffffff}{ext}`` of each row's file."""
    ts = F.lit(RUN_TS.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    path = F.col("source_file")
    return _union(spark, sf_dir).groupBy(_name(path), output_name(path, ts).alias("output")).agg(F.count("*").alias("rows"))


# --- the job over the folder, and its report (F7-F9, H2) ---------------------

def x3_job(spark, sf_dir):
    """The job's report; every query runs the job itself."""
    _, feeds = x3_dir(spark, sf_dir)
    return enrich_directory(spark, feeds, X.x3_reference(spark, sf_dir), X.x3_spec(),
                            out=scratch_path(spark, "job-out"), run_id="r1", ts=RUN_TS).report


_COUNTS = f"""SELECT name, o_orderstatus AS status, count(*) AS rows, count(sector) AS matched
FROM ({X.X3_ROWS_SQL}) GROUP BY name, o_orderstatus"""

_REPORT_SQL = f"""
SELECT name, CASE WHEN status = 'P' THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN status = 'P' THEN NULL ELSE rows END AS rows,
       CASE WHEN status = 'P' THEN NULL ELSE regexp_replace(name, '\\.csv$', '') || '_{STAMP}.csv' END AS output,
       CASE WHEN status = 'P' THEN 'Processing failed' ELSE NULL END AS error,
       CASE WHEN status = 'P' THEN NULL ELSE matched END AS matched,
       CASE WHEN status = 'P' THEN NULL ELSE rows - matched END AS unmatched
FROM ({_COUNTS})
UNION ALL SELECT 'header_only.csv', 'success', 0, 'header_only_{STAMP}.csv', NULL, 0, 0
UNION ALL SELECT 'empty.csv', 'failed', NULL, NULL, 'Processing failed', NULL, NULL"""


@register("enrich_directory", _REPORT_SQL)
def enrich_directory_q(spark, sf_dir):
    """The whole job over the folder: per-file status, rows, output, matches."""
    r = x3_job(spark, sf_dir)
    return r.select(_name(F.col("file")), "status", "rows", "output",
                    "error", "matched", "unmatched")


@register("run_summary", f"""
SELECT 'completed' AS status, count(*) FILTER (WHERE status = 'success') AS processed,
       count(*) FILTER (WHERE status <> 'success') AS errors, count(*) AS total_files,
       CASE WHEN count(*) FILTER (WHERE status <> 'success') = 0 THEN 'green' ELSE 'orange' END AS color
FROM ({_REPORT_SQL}) r""")
def run_summary_q(spark, sf_dir):
    """Run totals and severity."""
    return run_summary(x3_job(spark, sf_dir))


_SUMMARY_SQL = f"""
SELECT 'completed' AS status, count(*) FILTER (WHERE status = 'success') AS processed,
       count(*) FILTER (WHERE status <> 'success') AS errors, count(*) AS total_files,
       CASE WHEN count(*) FILTER (WHERE status <> 'success') = 0 THEN 'green' ELSE 'orange' END AS color
FROM ({_REPORT_SQL})"""


@register("run_status", f"""
SELECT 'no_files' AS status, 0 AS errors, 'red' AS color
UNION ALL SELECT 'db_error', CAST(count(*) AS INTEGER), 'red' FROM ({_REPORT_SQL})
UNION ALL SELECT 'critical_error', 1, 'red'
UNION ALL SELECT status, CAST(errors AS INTEGER), color FROM ({_SUMMARY_SQL})""")
def run_status(spark, sf_dir):
    """Status and severity class (F8) of four runs: the job's own, one over a
    folder without files, one whose reference is not there when it is opened,
    and one whose reference loses its files after that."""
    _, feeds = x3_dir(spark, sf_dir)
    ref = X.x3_reference(spark, sf_dir)
    bare, copy = scratch_path(spark, "bare"), scratch_path(spark, "reference")
    hadoop_mkdirs(spark, bare)
    ref.write.parquet(copy)
    lost = read_reference(spark, copy)
    hadoop_delete(spark, copy)
    runs = [run_summary(x3_job(spark, sf_dir)), enrich_directory(spark, bare, ref, X.x3_spec()).summary,
            enrich_directory(spark, feeds, lambda: read_reference(spark, f"{bare}/nothing"), X.x3_spec()).summary,
            enrich_directory(spark, feeds, lost, X.x3_spec(), on_error="report").summary]
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out.select("status", F.col("errors").cast("int").alias("errors"), "color")


@register("report_details", f"""
SELECT name, upper(status) AS status_label,
       CASE WHEN status = 'success' THEN rows END AS rows_processed,
       CASE WHEN status = 'success' THEN output END AS output_name,
       CASE WHEN status IN ('failed', 'error') THEN coalesce(error, 'Unknown error') END AS error_text
FROM ({_REPORT_SQL})""")
def report_details(spark, sf_dir):
    """Per-file detail lines (F9): rows/output only for successes, error text
    only for failures, defaults via coalesce (I6, I7)."""
    r = x3_job(spark, sf_dir)
    ok = F.col("status") == "success"
    return r.select(
        _name(F.col("file")), F.upper("status").alias("status_label"),
        F.when(ok, F.coalesce("rows", F.lit(0))).alias("rows_processed"),
        F.when(ok, F.col("output")).alias("output_name"),
        F.when(F.col("status").isin("failed", "error"),
               F.coalesce(F.col("error"), F.lit("Unknown error"))).alias("error_text"))


@register("layout_resolution", _counted(f"""
SELECT name,
  CASE status WHEN 'P' THEN NULL ELSE 'PNR_Number|Airline_Code|Travel_Sector' END AS keys,
  CASE status WHEN 'F' THEN 'Airline PNR|Airline Code|Sector' WHEN 'O' THEN 'PNRNUMBER|airlinecode|sector'
              ELSE NULL END AS sources,
  'Taxable_Amount|Booking_Date' AS missing
FROM ({_NAMES})
UNION ALL SELECT 'header_only.csv', 'PNR_Number|Airline_Code|Travel_Sector', 'Airline PNR|Airline Code|Sector',
  'Taxable_Amount|Booking_Date'"""))
def layout_resolution(spark, sf_dir):
    """Header resolution, key detection, key sources and missing targets for
    all files' layouts in one DataFrame plan, from the header records that
    tasks read, and the data rows of each file (C1, C3, C4, C6 distributed)."""
    heads = _headers(spark, sf_dir)
    plan = plan_layouts(layout_headers(heads), X.x3_spec())
    files = plan.select(F.col("layout_id").alias("path"), F.array_join("keys", "|").alias("keys"),
                        F.array_join("sources", "|").alias("sources"), F.array_join("missing", "|").alias("missing"))
    return _with_rows(files, heads).select(_name(F.col("path")), "keys", "sources", "missing", "rows")
