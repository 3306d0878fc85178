"""Queries over DataFrame feeds (fixtures X1, X2, X4): joins, filters,
first-per-key, header rules."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import fixtures as X
from ..functions.exprs import c, is_empty, na_to_null, normalize_header
from ..operators.enrich import (
    distinct_keys, enrich, first_per_key, key_frame, match_stats, matched, missing_key_rows,
    reference_semi, reference_semi_bitmap, unmatched, where_key,
)
from ..plans.headers import plan_layout
from ..session import scratch_path
from ..sources.files import hadoop_write_text
from ..sources.reference import key_in_filter, read_reference, reference_columns
from ..spec import EnrichSpec
from .registry import register

KEYS = ["PNR_Number", "Airline_Code", "Travel_Sector"]
FEED_KEYS = ['"Airline PNR/Prov. Booking"', '" AIRLINE code "', '"Sector"']
TARGETS_SQL = ('r.Taxable_Amount, r.NonTaxable_Amount, r.Cgst_Total AS "CGST", '
               'r.Booking_Date AS "Booking Date", r.Invoice_Number')
JOIN_SQL = f"""
FROM ({X.X1_FEED_SQL}) f LEFT JOIN ({X.X1_FIRST_SQL}) r
  ON {X.X1_VALID} AND f."Airline PNR/Prov. Booking" = r.PNR_Number
 AND f." AIRLINE code " = r.Airline_Code AND f."Sector" = r.Travel_Sector
"""


def _x1(spark, sf_dir):
    ref = X.x1_reference(spark, sf_dir)
    return X.x1_feed(spark, sf_dir), ref, X.x1_spec(ref)


@register("enrich_first_match", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL}")
def enrich_first_match(spark, sf_dir):
    feed, ref, spec = _x1(spark, sf_dir)
    return enrich(feed, ref, spec)


@register("enrich_null_fill", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL} WHERE r.PNR_Number IS NULL")
def enrich_null_fill(spark, sf_dir):
    feed, ref, spec = _x1(spark, sf_dir)
    out = enrich(feed, ref, spec, flag="__hit")
    return out.filter(~F.col("__hit")).drop("__hit")


@register("match_flag", f"SELECT f.*, {TARGETS_SQL}, r.PNR_Number IS NOT NULL AS matched {JOIN_SQL}")
def match_flag(spark, sf_dir):
    feed, ref, spec = _x1(spark, sf_dir)
    return enrich(feed, ref, spec, flag="matched")


@register("unmatched_rows", f"SELECT f.* {JOIN_SQL} WHERE r.PNR_Number IS NULL")
def unmatched_rows(spark, sf_dir):
    return unmatched(*_x1(spark, sf_dir))


@register("matched_rows", f"SELECT f.* {JOIN_SQL} WHERE r.PNR_Number IS NOT NULL")
def matched_rows(spark, sf_dir):
    return matched(*_x1(spark, sf_dir))


@register("first_per_key", f"""
SELECT PNR_Number, Airline_Code, Travel_Sector, Taxable_Amount, NonTaxable_Amount, Cgst_Total,
       Booking_Date, Invoice_Number, l_suppkey FROM ({X.X1_FIRST_SQL})""")
def first_per_key_q(spark, sf_dir):
    ref = X.x1_reference(spark, sf_dir)
    return first_per_key(ref, KEYS, X.X1_ORDER_BY,
                         ["Taxable_Amount", "NonTaxable_Amount", "Cgst_Total", "Booking_Date",
                          "Invoice_Number", "l_suppkey"])


@register("distinct_keys", f"""
SELECT DISTINCT "Airline PNR/Prov. Booking" AS PNR_Number, " AIRLINE code " AS Airline_Code,
       "Sector" AS Travel_Sector
FROM ({X.X1_FEED_SQL}) f WHERE {X.X1_VALID}""")
def distinct_keys_q(spark, sf_dir):
    feed, _, spec = _x1(spark, sf_dir)
    return distinct_keys(feed, spec)


@register("reference_semi", f"""
SELECT * FROM ({X.X1_REF_SQL}) r WHERE (PNR_Number, Airline_Code, Travel_Sector) IN (
  SELECT ("Airline PNR/Prov. Booking", " AIRLINE code ", "Sector") FROM ({X.X1_FEED_SQL}) f
  WHERE {X.X1_VALID})""")
def reference_semi_q(spark, sf_dir):
    feed, ref, spec = _x1(spark, sf_dir)
    return reference_semi(feed, ref, spec)


@register("reference_bitmap", f"""
SELECT * FROM ({X.X1_REF_SQL}) r WHERE (PNR_Number, Airline_Code, Travel_Sector) IN (
  SELECT ("Airline PNR/Prov. Booking", " AIRLINE code ", "Sector") FROM ({X.X1_FEED_SQL}) f
  WHERE {X.X1_VALID})""")
def reference_bitmap_q(spark, sf_dir):
    """The semi-join behind a key bitmap, for key sets beyond the broadcast bound (D3)."""
    feed, ref, spec = _x1(spark, sf_dir)
    return reference_semi_bitmap(feed, ref, spec)


@register("reference_scan", """
SELECT l_orderkey AS PNR_Number, l_linenumber AS Airline_Code, l_returnflag AS Travel_Sector,
       l_extendedprice AS Taxable_Amount, l_shipdate AS Booking_Date
FROM lineitem WHERE l_linestatus = 'F'""")
def reference_scan(spark, sf_dir):
    ref = read_reference(spark, f"{sf_dir}/lineitem.parquet", format="parquet",
                         rename={"l_orderkey": "PNR_Number", "l_linenumber": "Airline_Code",
                                 "l_returnflag": "Travel_Sector", "l_extendedprice": "Taxable_Amount",
                                 "l_shipdate": "Booking_Date"},
                         where=F.col("l_linestatus") == "F")
    return ref.select(*KEYS, "Taxable_Amount", "Booking_Date")


@register("match_stats", f"""
SELECT "Sector", count(*) AS rows, count(*) FILTER (WHERE r.PNR_Number IS NOT NULL) AS matched,
       count(*) FILTER (WHERE r.PNR_Number IS NULL) AS unmatched
{JOIN_SQL} GROUP BY "Sector" """)
def match_stats_q(spark, sf_dir):
    feed, ref, spec = _x1(spark, sf_dir)
    return match_stats(enrich(feed, ref, spec, flag="_matched"), "_matched", by=["Sector"])


@register("empty_value", f"""
SELECT {', '.join(FEED_KEYS)},
       "Airline PNR/Prov. Booking" IS NULL AS pnr_empty,
       " AIRLINE code " IS NULL AS code_empty,
       ("Sector" IS NULL OR trim("Sector") = '') AS sector_empty
FROM ({X.X1_FEED_SQL}) f""")
def empty_value(spark, sf_dir):
    feed = X.x1_feed(spark, sf_dir)
    types = {f.name: f.dataType for f in feed.schema.fields}
    cols = ["Airline PNR/Prov. Booking", " AIRLINE code ", "Sector"]
    return feed.select(*[c(n) for n in cols],
                       *[is_empty(c(n), types[n]).alias(a)
                         for n, a in zip(cols, ["pnr_empty", "code_empty", "sector_empty"])])


@register("missing_key_rows", f"SELECT * FROM ({X.X1_FEED_SQL}) f WHERE NOT {X.X1_VALID}")
def missing_key_rows_q(spark, sf_dir):
    feed, _, spec = _x1(spark, sf_dir)
    return missing_key_rows(feed, spec)


@register("where_key", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def where_key_q(spark, sf_dir):
    return where_key(X.table(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


@register("normalize_header", r"""
SELECT c_custkey, lower(regexp_replace(concat(chr(9), '  ', upper(c_name), ' ', chr(9)), '^\s+|\s+$', '', 'g'))
       AS header_key FROM customer""")
def normalize_header_q(spark, sf_dir):
    cust = X.table(spark, sf_dir, "customer")
    padded = F.concat(F.lit("\t  "), F.upper("c_name"), F.lit(" \t"))
    return cust.select("c_custkey", normalize_header(padded).alias("header_key"))


# --- X2: header variants on the X1 data -------------------------------------

def _variant(spark, sf_dir, names, extra=None):
    """X1 feed with its three key headers renamed (and optional extra columns)."""
    feed = X.x1_feed(spark, sf_dir)
    old = ["Airline PNR/Prov. Booking", " AIRLINE code ", "Sector"]
    cols = [c(o).alias(n) for o, n in zip(old, names)] + [c(n) for n in feed.columns if n not in old]
    return feed.select(*cols, *(extra or []))


def _variant_sql(names, extra_sql=""):
    return (f"""SELECT "Airline PNR/Prov. Booking" AS "{names[0]}", " AIRLINE code " AS "{names[1]}",
       "Sector" AS "{names[2]}", "Qty", l_partkey, l_suppkey{extra_sql} FROM ({X.X1_FEED_SQL}) x""")


def _join_sql(names, feed_sql, select, where=""):
    valid = (f'(f."{names[0]}" IS NOT NULL AND f."{names[1]}" IS NOT NULL AND f."{names[2]}" IS NOT NULL '
             f"AND regexp_matches(f.\"{names[2]}\", '^\\s*$') = false)")
    return f"""SELECT {select} FROM ({feed_sql}) f LEFT JOIN ({X.X1_FIRST_SQL}) r
  ON {valid} AND f."{names[0]}" = r.PNR_Number AND f."{names[1]}" = r.Airline_Code
 AND f."{names[2]}" = r.Travel_Sector {where}"""


CASE_NAMES = ["PNR NUMBER ", "AirlineCode", "  Travel SECTOR"]


@register("header_resolution", _join_sql(CASE_NAMES, _variant_sql(CASE_NAMES), f"f.*, {TARGETS_SQL}"))
def header_resolution(spark, sf_dir):
    """Case / whitespace variants of the aliases resolve by ``lower().strip()``."""
    ref = X.x1_reference(spark, sf_dir)
    return enrich(_variant(spark, sf_dir, CASE_NAMES), ref, X.x1_spec(ref))


# Two aliases of PNR: the first ('Airline PNR/Prov. Booking') is empty on the
# rows whose return flag is 'N'; the second ('Airline PNR') always has the key.
# The key comes from the first alias even where it is empty.
_ALIAS_FEED_SQL = f"""
SELECT CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_orderkey END AS "Airline PNR/Prov. Booking",
       l_orderkey AS "Airline PNR", l_linenumber AS "Airline Code", l_returnflag AS "Sector", l_quantity AS "Qty"
FROM lineitem WHERE l_linestatus = 'O'"""


def _alias_feed(spark, sf_dir):
    li = X.table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "O")
    return li.select(
        F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(F.col("l_orderkey")).alias(
            "Airline PNR/Prov. Booking"),
        F.col("l_orderkey").alias("Airline PNR"), F.col("l_linenumber").alias("Airline Code"),
        F.col("l_returnflag").alias("Sector"), F.col("l_quantity").alias("Qty"))


@register("alias_priority", f"""
SELECT f.*, {TARGETS_SQL} FROM ({_ALIAS_FEED_SQL}) f LEFT JOIN ({X.X1_FIRST_SQL}) r
  ON f."Airline PNR/Prov. Booking" = r.PNR_Number AND f."Airline Code" = r.Airline_Code
 AND f."Sector" = r.Travel_Sector""")
def alias_priority(spark, sf_dir):
    ref = X.x1_reference(spark, sf_dir)
    return enrich(_alias_feed(spark, sf_dir), ref, X.x1_spec(ref))


@register("canonical_rename", f"""
SELECT f.*, "Airline PNR/Prov. Booking" AS PNR_Number, "Airline Code" AS Airline_Code, "Sector" AS Travel_Sector,
       ("Airline PNR/Prov. Booking" IS NOT NULL AND "Airline Code" IS NOT NULL AND "Sector" IS NOT NULL
        AND regexp_matches("Sector", '^\\s*$') = false) AS key_valid
FROM ({_ALIAS_FEED_SQL}) f""")
def canonical_rename(spark, sf_dir):
    """Feed plus its canonical key columns and validity."""
    return key_frame(_alias_feed(spark, sf_dir), EnrichSpec())


_DISPLAY_NAMES = ["Airline PNR/Prov. Booking", " AIRLINE code ", "Sector"]


@register("display_rename", _join_sql(
    _DISPLAY_NAMES, _variant_sql(_DISPLAY_NAMES, ', "Qty" * 2 AS "CGST"'),
    'f.*, r.Taxable_Amount, r.NonTaxable_Amount, r.Cgst_Total AS "CGST__ref", '
    'r.Booking_Date AS "Booking Date", r.Invoice_Number'))
def display_rename(spark, sf_dir):
    """A feed that already has a display name ('CGST') keeps it; the appended
    column gets a suffix (deviation R16)."""
    ref = X.x1_reference(spark, sf_dir)
    feed = _variant(spark, sf_dir, _DISPLAY_NAMES, [(F.col("Qty") * 2).alias("CGST")])
    return enrich(feed, ref, X.x1_spec(ref))


@register("passthrough", _variant_sql(_DISPLAY_NAMES, ", " + ", ".join(
    f'l_partkey AS "{t}"' for t, _ in EnrichSpec().targets)))
def passthrough(spark, sf_dir):
    """All twelve targets present: the feed comes back unchanged and the
    reference is never scanned (C5, R13)."""
    ref = X.x1_reference(spark, sf_dir)
    feed = _variant(spark, sf_dir, _DISPLAY_NAMES, [F.col("l_partkey").alias(t) for t, _ in EnrichSpec().targets])
    out = enrich(feed, ref, EnrichSpec(order_by=X.X1_ORDER_BY))
    assert out is feed
    return out


@register("renamed_target_present", _join_sql(
    _DISPLAY_NAMES, _variant_sql(_DISPLAY_NAMES, ', "Qty" AS "Cgst_Total"'),
    'f.*, r.Taxable_Amount, r.NonTaxable_Amount, r.Booking_Date AS "Booking Date", r.Invoice_Number'))
def renamed_target_present(spark, sf_dir):
    """The feed has one renamed target under its reference name ('Cgst_Total'):
    it is kept untouched and not fetched (deviation R15: no KeyError)."""
    ref = X.x1_reference(spark, sf_dir)
    feed = _variant(spark, sf_dir, _DISPLAY_NAMES, [F.col("Qty").alias("Cgst_Total")])
    return enrich(feed, ref, X.x1_spec(ref))


@register("missing_targets", f"""
SELECT 1 AS pos, 'Taxable_Amount' AS target, 'Taxable_Amount' AS display, count(r.Taxable_Amount) AS filled {JOIN_SQL}
UNION ALL SELECT 2, 'NonTaxable_Amount', 'NonTaxable_Amount', count(r.NonTaxable_Amount) {JOIN_SQL}
UNION ALL SELECT 3, 'Booking_Date', 'Booking Date', count(r.Booking_Date) {JOIN_SQL}
UNION ALL SELECT 4, 'Invoice_Number', 'Invoice_Number', count(r.Invoice_Number) {JOIN_SQL}""")
def missing_targets_q(spark, sf_dir):
    """Targets the renamed-target feed lacks, in fixed order (C4), and in how
    many rows each was filled."""
    ref = X.x1_reference(spark, sf_dir)
    feed = _variant(spark, sf_dir, _DISPLAY_NAMES, [F.col("Qty").alias("Cgst_Total")])
    spec = X.x1_spec(ref)
    plan = plan_layout(feed.columns, spec)
    counts = enrich(feed, ref, spec).agg(*[F.count(c(n)).alias(f"n{i}") for i, n in enumerate(plan.appended)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("pos"), F.lit(col).alias("target"), F.lit(name).alias("display"), F.col(f"n{i}").alias("filled"))
        for i, ((col, _), name) in enumerate(zip(plan.missing, plan.appended))])))


@register("spec_from_json", f"SELECT f.*, {TARGETS_SQL} {JOIN_SQL}")
def spec_from_json(spark, sf_dir):
    """The X1 feed enriched by a spec read from a JSON file in the job's layout."""
    feed, ref, spec = _x1(spark, sf_dir)
    path = f"{scratch_path(spark, 'spec')}.json"
    hadoop_write_text(spark, path, json.dumps({
        "column_mapping": dict(spec.aliases), "possible_reference_combinations": [list(k) for k in spec.key_combinations],
        "targets": [list(t) for t in spec.targets], "order_by": list(spec.order_by), "supported_extensions": list(spec.extensions)}))
    return enrich(feed, ref, EnrichSpec.from_json(path, spark=spark))


# --- X4: NA tokens ----------------------------------------------------------

from ..functions.exprs import NA_TOKENS  # noqa: E402

_X4_TOKENS = ["", "NA", "null", "N/A", " "]


def _x4_sql_value():
    cases = " ".join(f"WHEN event_id % 6 = {i} THEN '{t}'" for i, t in enumerate(_X4_TOKENS))
    return f"CASE {cases} ELSE event_type END"


@register("na_tokens", f"""
SELECT event_id, raw, CASE WHEN raw IN ({', '.join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)})
                      THEN NULL ELSE raw END AS value,
       (raw IN ({', '.join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)}) OR trim(raw) = '') AS empty_key
FROM (SELECT event_id, {_x4_sql_value()} AS raw FROM events)""")
def na_tokens(spark, sf_dir):
    """Reader NA tokens become NULL; a blank string is not a token but is an
    empty key (A7, R6)."""
    ev = X.table(spark, sf_dir, "events")
    raw = F.col("event_type")
    for i, t in reversed(list(enumerate(_X4_TOKENS))):
        raw = F.when(F.col("event_id") % 6 == i, F.lit(t)).otherwise(raw)
    df = ev.select("event_id", raw.alias("raw"))
    value = na_to_null(F.col("raw"))
    from pyspark.sql import types as T
    return df.select("event_id", "raw", value.alias("value"), is_empty(value, T.StringType()).alias("empty_key"))


_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("reference_columns", " UNION ALL ".join(
    f"SELECT {i} AS pos, '{n}' AS name, count({n}) AS filled, count(DISTINCT {n}) AS n_values FROM customer"
    for i, n in enumerate(_CUSTOMER, 1)))
def reference_columns_q(spark, sf_dir):
    """Ordered reference schema (A11), with filled and distinct values of each column."""
    ref = X.table(spark, sf_dir, "customer")
    cols = reference_columns(ref)
    long = ref.select(F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), c(n).cast("string").alias("v"))
                                          for i, n in enumerate(cols, 1)])).alias("x")).select("x.*")
    return long.groupBy("pos", "name", "v").agg(F.count("v").alias("n")).groupBy("pos", "name").agg(
        F.sum("n").alias("filled"), F.count("v").alias("n_values"))


@register("reference_in_filter", f"""
SELECT * FROM ({X.X1_REF_SQL}) r WHERE (PNR_Number, Airline_Code, Travel_Sector) IN (
  SELECT ("Airline PNR/Prov. Booking", " AIRLINE code ", "Sector") FROM ({X.X1_FEED_SQL}) f
  WHERE {X.X1_VALID})""")
def reference_in_filter(spark, sf_dir):
    """Feed-key ``IN`` superset pushed into the reference scan for key columns
    with few distinct values, then the exact semi-join (D3b)."""
    feed, ref, spec = _x1(spark, sf_dir)
    kf = key_frame(feed, spec, ref.schema).filter(F.col("key_valid")).select(*KEYS)
    reduced = key_in_filter(ref, kf, KEYS)
    return reference_semi(feed, reduced, spec)
