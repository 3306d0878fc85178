"""Reference-table sources.

The reference is any DataFrame; these helpers read it from parquet, a catalog
table, or JDBC, with the projection and filters expressed so Catalyst pushes
them into the scan (parquet ``ReadSchema``/``PushedFilters``; JDBC column
pruning and ``In`` filters)."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import c


def read_reference(spark: SparkSession, source: str, *, format: str = "parquet",
                   options: Mapping[str, str] | None = None, rename: Mapping[str, str] | None = None,
                   where: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Open a reference table.

    ``format`` is ``parquet``/``orc``/... (``source`` is a path), ``table``
    (``source`` is a catalog name) or ``jdbc`` (``source`` is ``dbtable``;
    ``options`` carry url/driver/partitioning). ``rename`` maps stored names to
    canonical ones; ``columns`` prunes to the canonical names the job needs."""
    options = dict(options or {})
    if format == "table":
        df = spark.read.table(source)
    elif format == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **options).load()
    else:
        df = spark.read.format(format).options(**options).load(source)
    if where is not None:
        df = df.filter(where)
    if rename:
        df = df.select(*[c(n).alias(rename.get(n, n)) for n in df.columns])
    if columns is not None:
        df = df.select(*[c(n) for n in columns])
    return df


def reference_columns(reference: DataFrame) -> list[str]:
    """Ordered column names of the reference."""
    return list(reference.columns)


def key_in_filter(reference: DataFrame, feed_keys: DataFrame, key_columns: Sequence[str],
                  max_values: int = 1000) -> DataFrame:
    """Per-column ``IN`` superset filter (D3b): for every key column whose
    distinct feed values are few (HyperLogLog estimate checked first, then
    collected), ``isin`` of those values is added to the reference. A parquet
    or JDBC source pushes it into the scan (``PushedFilters: In``), the way the
    job let the database evaluate its composite ``IN``. The exact composite
    match still happens in the join; columns with many values are skipped, so
    nothing unbounded reaches the driver.

    ``feed_keys`` has the key columns under the reference's names. A column
    whose feed type is neither the reference's nor numeric like it is skipped:
    its values would need a cast that can fail or keep the filter from the scan."""
    feed_types = {f.name: f.dataType for f in feed_keys.schema.fields}
    ref_types = {f.name: f.dataType for f in reference.schema.fields}
    key_columns = [k for k in key_columns if feed_types[k] == ref_types[k]
                   or all(isinstance(t, T.IntegralType) for t in (feed_types[k], ref_types[k]))]
    if not key_columns:
        return reference
    est = feed_keys.agg(*[F.approx_count_distinct(c(k), 0.02).alias(f"n{i}")
                          for i, k in enumerate(key_columns)]).first()
    small = [k for i, k in enumerate(key_columns) if est[f"n{i}"] <= max_values * 0.9]
    if not small:
        return reference
    sets = feed_keys.agg(*[F.collect_set(c(k)).alias(f"s{i}") for i, k in enumerate(small)]).first()
    out = reference
    for i, k in enumerate(small):
        values = [v for v in sets[f"s{i}"] if v is not None]
        if len(values) <= max_values:
            out = out.filter(c(k).isin(values) if values else F.lit(False))
    return out
