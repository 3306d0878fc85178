"""Roll-ups over enriched rows (F4-F6, H1): all are partial+final hash
aggregates, so each executor pre-aggregates before the shuffle and a hot file
or sheet costs one row per task, not its rows."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import c


def rows_per_sheet(df: DataFrame, file_col: str = "source_file", sheet_col: str = "sheet") -> DataFrame:
    """Rows per loaded sheet."""
    return df.groupBy(c(file_col).alias(file_col), c(sheet_col).alias(sheet_col)).agg(
        F.count(F.lit(1)).alias("rows"))


def rows_per_file(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows per file, summed over its sheets."""
    return df.groupBy(c(file_col).alias(file_col)).agg(F.count(F.lit(1)).alias("rows"))


def sheets_info(df: DataFrame, file_col: str = "source_file", sheet_col: str = "sheet") -> DataFrame:
    """Per file: number of sheets, total rows and a ``sheet -> rows`` map.
    The map is built from the per-sheet counts, so its size is the number of
    sheets in one workbook, never the number of rows."""
    per = rows_per_sheet(df, file_col, sheet_col)
    return per.groupBy(file_col).agg(
        F.count(F.lit(1)).cast("int").alias("sheets"),
        F.sum("rows").alias("rows"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(sheet_col), F.col("rows"))))).alias(
            "sheets_info"))


def map_text(col) -> F.Column:
    """``k=v,k=v`` in key order: a portable text form of a string->number map."""
    entries = F.array_sort(F.map_entries(col))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
                        ",")


def union_sheets(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of enriched sheets by column name; absent columns are NULL (H1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
