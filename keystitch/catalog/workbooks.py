"""Queries over workbooks that Spark writes from `nation`, `region` and
`customer` (X5): parse, header detection, sheet filtering, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as X
from ..functions.exprs import base_name, c
from ..job import enrich_directory
from ..operators.enrich import enrich
from ..operators.report import map_text, union_sheets
from ..plans.headers import NoKeyColumns
from ..plans.wide import project, union_labels
from ..session import scratch_path
from ..sources.files import list_feeds
from ..sources.workbook import header_rows, read_workbooks, sheet_layouts
from ..spec import EnrichSpec
from .registry import register

_BUILT: dict = {}
_BOOK_B = "'book_b_' || (c_custkey // 1000) || '.xlsx'"


def x5_dir(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        root = scratch_path(spark, "x5")
        _BUILT[key] = X.build_x5(spark, sf_dir, root)
    return _BUILT[key]


def _books(spark, sf_dir):
    folder = x5_dir(spark, sf_dir)
    return read_workbooks(spark, [f.path for f in list_feeds(spark, folder, (".xlsx",))])


def _spec():
    return EnrichSpec().with_targets(["Taxable_Amount"])


@register("workbook_scan", f"""
SELECT 'book_a.xlsx' AS name, 'Nations' AS sheet, CAST(0 AS BIGINT) AS row_idx, 'Nation list' AS c0,
       NULL::VARCHAR AS c1, NULL::VARCHAR AS c2, NULL::VARCHAR AS c3
UNION ALL SELECT 'book_a.xlsx', 'Nations', 1, 'source: nation', NULL, NULL, NULL
UNION ALL SELECT 'book_a.xlsx', 'Nations', 2, 'n_nationkey', 'n_name', 'n_regionkey', NULL
UNION ALL SELECT 'book_a.xlsx', 'Nations', 2 + row_number() OVER (ORDER BY n_nationkey),
       CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR), NULL FROM nation
UNION ALL SELECT 'book_a.xlsx', 'Regions', 0, 'r_regionkey', 'r_name', NULL, NULL
UNION ALL SELECT 'book_a.xlsx', 'Regions', row_number() OVER (ORDER BY r_regionkey),
       CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL FROM region
UNION ALL SELECT DISTINCT {_BOOK_B}, 'Customers', 0, 'Airline PNR', 'Airline Code', 'Sector', 'Customer' FROM customer
UNION ALL SELECT {_BOOK_B}, 'Customers', row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey),
       CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), c_mktsegment, c_name FROM customer
UNION ALL SELECT DISTINCT {_BOOK_B}, 'Numbers', 0, '2024', 'c_custkey', 'segment', NULL FROM customer
UNION ALL SELECT {_BOOK_B}, 'Numbers', row_number() OVER (PARTITION BY c_custkey // 1000 ORDER BY c_custkey),
       CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), c_mktsegment, NULL FROM customer""")
def workbook_scan(spark, sf_dir):
    """Every non-blank row of every sheet, cells as text (A3); the empty sheet has none."""
    cells = _books(spark, sf_dir).cells
    return cells.select(base_name(F.col("source_file")).alias("name"), "sheet", "row_idx",
                        *[F.get(F.col("cells"), i).alias(f"c{i}") for i in range(4)])


@register("header_detect", f"""
SELECT * FROM (VALUES ('book_a.xlsx', 'Nations', 0, 3, CAST(2 AS BIGINT)), ('book_a.xlsx', 'Regions', 1, 2, 0))
  t(name, sheet, sheet_pos, width, header_row)
UNION ALL SELECT DISTINCT {_BOOK_B}, 'Customers', 0, 4, 0 FROM customer
UNION ALL SELECT DISTINCT {_BOOK_B}, 'Numbers', 1, 3, 0 FROM customer""")
def header_detect(spark, sf_dir):
    """Header row per sheet: first of 10 rows with > 2 cells, all text; else 0 (A4)."""
    h = header_rows(_books(spark, sf_dir).cells)
    return h.select(base_name(F.col("source_file")).alias("name"), "sheet", "sheet_pos", "width", "header_row")


@register("nonempty_sheets", f"""
SELECT 'book_a.xlsx' AS name, 'Nations' AS sheet, count(*) AS rows FROM nation
UNION ALL SELECT 'book_a.xlsx', 'Regions', count(*) FROM region
UNION ALL SELECT {_BOOK_B}, 'Customers', count(*) FROM customer GROUP BY ALL
UNION ALL SELECT {_BOOK_B}, 'Numbers', count(*) FROM customer GROUP BY ALL""")
def nonempty_sheets(spark, sf_dir):
    """Sheets with data rows after their header, with row counts."""
    frames = [lay.frame.select("source_file", "sheet") for lay in _books(spark, sf_dir).layouts]
    rows = union_sheets(frames).groupBy("source_file", "sheet").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(base_name(F.col("source_file")).alias("name"), "sheet", "rows")


@register("workbook_enrich", """
SELECT f.c_custkey AS "Airline PNR", f.c_name AS "Customer", r.c_acctbal AS "Taxable_Amount", 'Customers' AS sheet
FROM customer f LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) r
  ON f.c_custkey = r.c_custkey AND f.c_nationkey = r.c_nationkey AND f.c_mktsegment = r.c_mktsegment""")
def workbook_enrich(spark, sf_dir):
    """The keyed sheets enriched; text cells are compared to numeric reference
    keys as numbers (H3)."""
    books = _books(spark, sf_dir)
    ref = X.x5_reference(spark, sf_dir)
    out = []
    for lay in books.layouts:
        try:
            out.append(enrich(lay.frame, ref, _spec()))
        except NoKeyColumns:   # sheets without keys are dropped (R18)
            continue
    df = union_sheets(out)
    return df.select(c("Airline PNR").cast("bigint").alias("Airline PNR"), c("Customer"),
                     c("Taxable_Amount"), "sheet")


@register("workbook_report", f"""
SELECT 'book_a.xlsx' AS name, 'failed' AS status, NULL::BIGINT AS rows, NULL::INTEGER AS sheets,
       NULL::VARCHAR AS sheets_info, NULL::BIGINT AS matched, NULL::VARCHAR AS failed_sheets
UNION ALL SELECT {_BOOK_B}, 'success', count(*), 1, 'Customers=' || CAST(count(*) AS VARCHAR),
       count(*) FILTER (WHERE c_acctbal >= 0), 'Numbers' FROM customer GROUP BY {_BOOK_B}""")
def workbook_report(spark, sf_dir):
    """The job over workbooks: sheets without keys are dropped, a workbook
    with no surviving sheet fails (R18, R19); sheets_info per file (F5)."""
    folder = x5_dir(spark, sf_dir)
    res = enrich_directory(spark, folder, X.x5_reference(spark, sf_dir), _spec(),
                           out=scratch_path(spark, "wb-out"), run_id="r1")
    r = res.report
    return r.select(base_name(F.col("file")).alias("name"), "status", "rows", "sheets",
                    map_text(F.col("sheets_info")).alias("sheets_info"), "matched",
                    F.array_join("failed_sheets", ",").alias("failed_sheets"))


@register("sheet_union_by_name", f"""
SELECT 'book_a.xlsx' AS name, 'Nations' AS sheet, CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
UNION ALL BY NAME SELECT 'book_a.xlsx' AS name, 'Regions' AS sheet, CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region
UNION ALL BY NAME SELECT {_BOOK_B} AS name, 'Customers' AS sheet, CAST(c_custkey AS VARCHAR) AS "Airline PNR", CAST(c_nationkey AS VARCHAR) AS "Airline Code",
  c_mktsegment AS "Sector", c_name AS "Customer" FROM customer
UNION ALL BY NAME SELECT {_BOOK_B} AS name, 'Numbers' AS sheet, CAST(c_custkey AS VARCHAR) AS "2024", CAST(c_nationkey AS VARCHAR) AS c_custkey, c_mktsegment AS segment FROM customer""")
def sheet_union_by_name(spark, sf_dir):
    """Sheets of different columns as one frame, by name (H1): one pass over
    the parsed cells and a projection by data."""
    cells = _books(spark, sf_dir).cells
    heads = sheet_layouts(cells)
    rows = cells.where("error is null").select("source_file", "sheet", "row_idx", "cells")
    after = heads.select("source_file", "sheet", "header_row")
    rows = rows.join(after, ["source_file", "sheet"]).where("row_idx > header_row")
    labels = union_labels(heads)
    wide = project(rows, heads, ["source_file", "sheet"], labels)
    return wide.withColumn("name", base_name(F.col("source_file"))).drop("source_file")
