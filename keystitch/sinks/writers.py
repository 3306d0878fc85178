"""Sinks (B1-B3): partitioned, replay-safe writes and output names."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import broadcast_threshold


def output_names(paths: Sequence[str], ts: datetime) -> dict[str, str]:
    """``{stem}_{YYYYMMDDHHMMSSffffff}[_n]{ext}`` per input (B3): '.csv' stays,
    anything else becomes '.xlsx'; equal names get ``_1``, ``_2`` ... in path
    order. File names are listing metadata, so this runs on the driver."""
    stamp = ts.strftime("%Y%m%d%H%M%S%f")
    seen: dict[str, int] = defaultdict(int)
    out = {}
    for p in sorted(paths):
        base = p.rstrip("/").rsplit("/", 1)[-1]
        stem, dot, ext = base.rpartition(".")
        if not dot or not stem:
            stem, ext = base, ""
        out_ext = ".csv" if ("." + ext).lower() == ".csv" else ".xlsx"
        key = f"{stem}_{stamp}{out_ext}"
        n = seen[key]
        seen[key] += 1
        out[p] = key if n == 0 else f"{stem}_{stamp}_{n}{out_ext}"
    return out


def attach_output(df: DataFrame, file_col: str, names: dict[str, str], out_col: str = "output",
                  how: str = "left") -> DataFrame:
    """Join each row's file to its output name. The name table has one row per
    listed file (a bound known from the listing), so it is broadcast when that
    bound fits the broadcast threshold and left to AQE otherwise."""
    spark = df.sparkSession
    table = spark.createDataFrame(sorted(names.items()), f"{file_col} string, {out_col} string")
    if len(names) * 512 <= broadcast_threshold(spark):
        table = F.broadcast(table)
    return df.join(table, file_col, how)


def partition_names(data_columns: Sequence[str], wanted: Sequence[str]) -> dict[str, str]:
    """Names of the partition columns: one that a data column has (in any case,
    as folders and readers may not tell) gets ``ks_`` in front, so that no data
    column is lost."""
    taken = {n.lower() for n in data_columns}
    out = {}
    for name in wanted:
        label = name
        while label.lower() in taken:
            label = "ks_" + label
        taken.add(label.lower())
        out[name] = label
    return out


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "csv",
                      header: bool = True) -> None:
    """Dynamic partition overwrite: a replayed batch replaces exactly its own
    partitions and leaves the others (H9)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        w = csv_options(w.option("header", header))
    w.format(fmt).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV without an index column (B1)."""
    csv_options(df.write.mode("overwrite").option("header", True)).csv(path)


def csv_options(w):
    """Quote with doubled quotes and keep cell whitespace as is."""
    return (w.option("escape", '"').option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False))


def read_csv_output(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read a written CSV output back with all-string columns in written order."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("enforceSchema", True).csv(path))
