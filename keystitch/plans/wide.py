"""All layouts in one plan.

A union by name of very many layouts, written as a union, is a plan with a
branch per layout. Here it is one scan and a projection by data: each row's
cells are an array, and a small table says, per file (or sheet), at which
position it has each label of the union. A label that a file lacks is NULL in
its rows. A thousand layouts are the same plan as one.

Labels that differ only in case are one column, under the spelling that comes
first in code point order, unless ``case_sensitive``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import NA_TOKENS, c, na_to_null
from ..operators.enrich import broadcast_threshold
from ..sources import records as R
from ..sources.csv import TYPE_PATTERNS, _conf_bytes

_AT, _CELLS, _TEXT = "__ks_at_label", "__ks_cells", "__ks_text"


def union_labels(layouts: DataFrame, case_sensitive: bool = False) -> list[str]:
    """Distinct kept labels of a table with ``names`` and ``kept``: the columns
    of the union (schema-sized, the driver needs them)."""
    kept = layouts.where("names is not null").select(F.explode(F.transform("kept", lambda p: F.get(F.col("names"), p))).alias("label"))
    key = F.col("label") if case_sensitive else F.lower("label")
    return [r["label"] for r in kept.groupBy(key.alias("k")).agg(F.min("label").alias("label")).orderBy("label").collect()]


def positions(layouts: DataFrame, labels: Sequence[str], case_sensitive: bool = False) -> Column:
    """Array over ``labels``: position of each in a layout's cells, NULL where it has none."""
    fold = (lambda x: x) if case_sensitive else F.lower
    mine = F.transform("kept", lambda p: fold(F.get(F.col("names"), p)))
    wanted = F.array(*[F.lit(x if case_sensitive else x.lower()) for x in labels])
    return F.transform(wanted, lambda label: F.get(F.col("kept"), F.nullif(F.array_position(mine, label), F.lit(0)).cast("int") - 1))


def project(rows: DataFrame, layouts: DataFrame, keys: Sequence[str], labels: Sequence[str], cells: str = "cells", *,
            case_sensitive: bool = False, na_tokens: Sequence[str] = NA_TOKENS, carry: Sequence[str] = (), bound: int | None = None) -> DataFrame:
    """``rows`` (``keys``, an array of cell texts) with one column per label.
    ``layouts`` has ``keys``, ``names`` and ``kept``; ``bound``: its rows at
    most, for a broadcast below the threshold."""
    table = layouts.where("names is not null").select(*keys, positions(layouts, labels, case_sensitive).alias(_AT))
    if bound is not None and bound * (512 + 8 * len(labels)) <= broadcast_threshold(rows.sparkSession):
        table = F.broadcast(table)
    both = rows.join(table, list(keys))
    cols = [F.get(c(cells), F.get(F.col(_AT), i)).alias(f"__ks_v{i}") for i in range(len(labels))]
    found = both.select(*[c(k) for k in (*keys, *carry)], *cols)
    return found.select(*[c(k) for k in (*keys, *carry)], *[na_to_null(f"__ks_v{i}", list(na_tokens)).alias(n) for i, n in enumerate(labels)])


def csv_cells(spark: SparkSession, headers: DataFrame, *, delimiter: str = ",", file_col: str = "source_file") -> tuple[DataFrame, int]:
    """(rows of all CSV files of a header table in one scan, number of files):
    ``file_col``, ``row_idx``, the record's cells at the greatest width."""
    files = [(r["path"], r["length"]) for r in headers.where("names is not null").select("path", "length").collect()]   # the listing
    width = headers.agg(F.max(F.size("names"))).first()[0] or 1
    if not files:
        return spark.createDataFrame([], f"`{file_col}` string, row_idx long, cells array<string>"), 0
    paths = [p for p, _ in files]
    whole = min(_conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20), _conf_bytes(spark, "spark.sql.files.openCostInBytes", 4 << 20))
    splits = [p for p, n in files if n is None or n > whole]
    known = R.borders(spark, splits, delimiter)
    rows = R.records(spark, paths, delimiter, known).where(F.col(R.KIND).isin(R.RECORD, R.OPEN))
    table = R.file_table(spark, paths, file_col)
    rows = rows.join(F.broadcast(table) if len(paths) * 512 <= broadcast_threshold(spark) else table, R.FID)
    rows, place = R.numbered(spark, rows, splits, delimiter, known)
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = rows.select(c(file_col), place.alias("row_idx"), F.from_csv(F.col(R.RAW).cast("string"), schema, {
        "sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxColumns": str(max(20480, 2 * width))}).alias("x"))
    return parsed.select(file_col, "row_idx", F.array(*[F.col(f"x.c{i}") for i in range(width)]).alias("cells")), len(files)


def union_csv(spark: SparkSession, headers: DataFrame, *, delimiter: str = ",", case_sensitive: bool = False,
              file_col: str = "source_file", na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Every row of every layout, by name, in one plan: ``file_col``,
    ``row_idx`` and a text column per label of the union."""
    labels = union_labels(headers, case_sensitive)
    rows, n = csv_cells(spark, headers, delimiter=delimiter, file_col=file_col)
    layouts = headers.withColumnRenamed("path", file_col)
    return project(rows, layouts, [file_col], labels, case_sensitive=case_sensitive, na_tokens=na_tokens, carry=["row_idx"], bound=n)


# --- types ---------------------------------------------------------------------------

# What a column of one file may be, from narrow to wide; a bigint is a double too.
CANDIDATES = ("bigint", "double", "boolean")


def _join_types(types: Column) -> Column:
    """Least common type of a set of types: no values at all is any type."""
    has = lambda t: F.array_contains(types, t)
    return (F.when(F.size(types) == 0, F.lit("string")).when(has("string"), F.lit("string"))
            .when(has("boolean") & (has("bigint") | has("double")), F.lit("string"))
            .when(has("boolean"), F.lit("boolean")).when(has("double"), F.lit("double")).otherwise(F.lit("bigint")))


def file_types(rows: DataFrame, columns: Sequence[str], file_col: str = "source_file") -> DataFrame:
    """``(file, label, type, n)``: per file and text column the narrowest type
    all its values are written as (:data:`TYPE_PATTERNS`) and cast to, and how
    many values there are. One aggregate over (file, label, value), partial in
    each task."""
    pairs = F.array(*[F.struct(F.lit(n).alias("label"), c(n).alias("v")) for n in columns])
    values = rows.select(c(file_col).alias("file"), F.explode(pairs).alias("x")).select("file", "x.label", "x.v").where("v is not null")
    fits = [(F.col("v").rlike(TYPE_PATTERNS[t]) & F.col("v").try_cast(t).isNotNull()) for t in CANDIDATES]
    per = values.groupBy("file", "label").agg(F.count(F.lit(1)).alias("n"), *[F.every(ok).alias(t) for t, ok in zip(CANDIDATES, fits)])
    kind = F.lit("string")
    for t in reversed(CANDIDATES):
        kind = F.when(F.col(t), F.lit(t)).otherwise(kind)
    return per.select("file", "label", kind.alias("type"), "n")


def union_types(per_file: DataFrame) -> DataFrame:
    """``(label, type, files)``: the least type that holds every file's."""
    return per_file.groupBy("label").agg(_join_types(F.collect_set("type")).alias("type"), F.count(F.lit(1)).alias("files"))


def typed(rows: DataFrame, columns: Sequence[str], file_col: str = "source_file") -> DataFrame:
    """``rows`` with every text column cast to its least common type."""
    chosen = {r["label"]: r["type"] for r in union_types(file_types(rows, columns, file_col)).collect()}   # one row a label
    return rows.select(*[c(n).try_cast(chosen[n]).alias(n) if chosen.get(n, "string") != "string" else c(n) for n in rows.columns])
