"""Queries over file/sheet roll-ups (X6: `orders` with source_file :=
o_orderstatus and sheet := o_orderpriority)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as X
from ..operators.enrich import enrich
from ..operators.report import map_text, rows_per_file, rows_per_sheet, sheets_info
from ..session import scratch_path
from ..sinks.writers import write_partitioned
from ..spec import EnrichSpec
from .registry import register


def x6(spark, sf_dir):
    o = X.table(spark, sf_dir, "orders")
    return o.select("*", F.col("o_orderstatus").alias("source_file"), F.col("o_orderpriority").alias("sheet"))


@register("rows_per_sheet", """
SELECT o_orderstatus AS source_file, o_orderpriority AS sheet, count(*) AS rows FROM orders GROUP BY ALL""")
def rows_per_sheet_q(spark, sf_dir):
    return rows_per_sheet(x6(spark, sf_dir))


@register("rows_per_file", "SELECT o_orderstatus AS source_file, count(*) AS rows FROM orders GROUP BY ALL")
def rows_per_file_q(spark, sf_dir):
    return rows_per_file(x6(spark, sf_dir))


@register("sheets_info", """
SELECT source_file, CAST(count(*) AS INTEGER) AS sheets, CAST(sum(rows) AS BIGINT) AS rows,
       string_agg(sheet || '=' || CAST(rows AS VARCHAR), ',' ORDER BY sheet) AS sheets_info
FROM (SELECT o_orderstatus AS source_file, o_orderpriority AS sheet, count(*) AS rows FROM orders GROUP BY ALL)
GROUP BY source_file""")
def sheets_info_q(spark, sf_dir):
    """Sheet count and {sheet: rows} per file (F5); the map is shown as sorted text."""
    s = sheets_info(x6(spark, sf_dir))
    return s.select("source_file", "sheets", "rows", map_text(F.col("sheets_info")).alias("sheets_info"))


# Sheets with their own extra column; one that a sheet lacks is NULL there (H1).
_SHEET_EXTRA = {"1-URGENT": "Urgent Note", "2-HIGH": "High Note"}


@register("sheet_union", """
SELECT o_orderkey AS "Airline PNR", o_custkey AS "Airline Code", o_orderpriority AS "Sector",
       o_orderstatus AS source_file, o_orderpriority AS sheet,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS "Urgent Note",
       CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END AS "High Note",
       o_totalprice AS Taxable_Amount
FROM orders""")
def sheet_union(spark, sf_dir):
    """Sheets of one key layout in one frame, whatever sheets there are: the
    union by name is the frame with each sheet's own column NULL elsewhere, so
    feed and reference are read once and shuffled once."""
    o = X.table(spark, sf_dir, "orders")
    sheet = F.col("o_orderpriority")
    feed = o.select(F.col("o_orderkey").alias("Airline PNR"), F.col("o_custkey").alias("Airline Code"),
                    sheet.alias("Sector"), F.col("o_orderstatus").alias("source_file"), sheet.alias("sheet"),
                    *[F.when(sheet == s, F.col("o_totalprice")).alias(n) for s, n in _SHEET_EXTRA.items()])
    spec = EnrichSpec(order_by=("Booking_Date",)).with_targets(["Taxable_Amount"])
    return enrich(feed, X.x3_reference(spark, sf_dir), spec)


@register("sheet_partitioned_write", """
SELECT o_orderkey, o_totalprice, o_orderstatus AS source_file, o_orderpriority AS sheet FROM orders""")
def sheet_partitioned_write(spark, sf_dir):
    """One output folder per input file and sheet (B2, re-aimed from xlsx
    sheets to partition folders), read back."""
    path = scratch_path(spark, "sheets")
    df = x6(spark, sf_dir).select("o_orderkey", "o_totalprice", "source_file", "sheet")
    write_partitioned(df, path, ["source_file", "sheet"], fmt="parquet")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "source_file", "sheet")
