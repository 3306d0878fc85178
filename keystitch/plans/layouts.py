"""Header resolution for many layouts at once (C1, C3, C4, C6 distributed).

When a folder holds very many distinct layouts (thousands of partner
formats), resolving them one by one on the driver becomes the bottleneck.
This module does the same decisions as :mod:`keystitch.plans.headers` as one
DataFrame plan over a ``headers(layout_id, pos, header)`` table:

* aliases × headers joined on the exact text and on ``lower(strip(..))``; the
  alias table is the spec's alias list, a fixed small broadcast;
* R1 per (layout, alias): the exact match if any, else the lowest position;
* R2 per (layout, column): the last alias that hit it names it, the first one
  fixes its place in mapping order;
* R5 key combination: the first combination with no column missing;
* R3/R4 key source: the column whose first hit comes earliest, else the
  column literally named like the key;
* R12 missing targets: target names that are no header of the layout.

Per-layout arrays are bounded by the number of columns of one layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import normalize_header, normalize_header_py
from ..spec import EnrichSpec


def _alias_table(spark, spec: EnrichSpec) -> DataFrame:
    rows = [(r, h, normalize_header_py(h), canon) for r, (h, canon) in enumerate(spec.aliases)]
    table = spark.createDataFrame(rows, "rank int, alias string, alias_norm string, canonical string")
    return F.broadcast(table)   # bounded by the spec's alias list


def resolve_layouts(headers: DataFrame, spec: EnrichSpec) -> DataFrame:
    """(layout_id, pos, header, canonical, first_rank) for every header;
    canonical/first_rank NULL when no alias maps the column."""
    al = _alias_table(headers.sparkSession, spec)
    h = headers.select("layout_id", "pos", "header", normalize_header(F.col("header")).alias("norm"))
    exact = h.join(al, h["header"] == al["alias"]).select("layout_id", "rank", "pos", "canonical",
                                                          F.lit(0).alias("kind"))
    loose = h.join(al, h["norm"] == al["alias_norm"]).select("layout_id", "rank", "pos", "canonical",
                                                             F.lit(1).alias("kind"))
    hits = exact.unionByName(loose)
    # One column per (layout, alias): exact beats case-insensitive, then position
    pick = hits.groupBy("layout_id", "rank").agg(
        F.min_by("pos", F.struct("kind", "pos")).alias("pos"), F.first("canonical").alias("canonical"))
    # R2: per column the last alias wins, the first fixes the mapping order
    per_col = pick.groupBy("layout_id", "pos").agg(
        F.max_by("canonical", "rank").alias("canonical"), F.min("rank").alias("first_rank"))
    return headers.join(per_col, ["layout_id", "pos"], "left").select(
        "layout_id", "pos", "header", "canonical", "first_rank")


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def plan_layouts(headers: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Per layout: ``keys`` (first fully present combination or NULL),
    ``sources`` (feed column per key), ``missing`` (targets not in headers)."""
    r = resolve_layouts(headers, spec)
    named = r.select("layout_id", "header", "canonical", "first_rank",
                     F.coalesce("canonical", "header").alias("renamed"))
    per = named.groupBy("layout_id").agg(
        F.collect_set("renamed").alias("present"),
        F.collect_set("header").alias("headers"),
        F.collect_list(F.when(F.col("canonical").isNotNull(),
                              F.struct("first_rank", "canonical", "header"))).alias("mapped"))
    combos = F.array(*[_lit_array(list(cmb)) for cmb in spec.key_combinations])
    keys = F.get(F.filter(combos, lambda cmb: F.size(F.array_except(cmb, F.col("present"))) == 0), 0)
    mapped = F.array_sort(F.col("mapped"))

    def source(k):
        hits = F.filter(mapped, lambda m: m["canonical"] == k)
        return F.when(F.size(hits) > 0, hits[0]["header"]).otherwise(k)

    out = per.select("layout_id", keys.alias("keys"), "headers", mapped.alias("mapped"))
    out = out.select("layout_id", "keys", F.transform("keys", source).alias("sources"),
                     F.filter(_lit_array(spec.target_columns),
                              lambda t: ~F.array_contains(F.col("headers"), t)).alias("missing"))
    return out
