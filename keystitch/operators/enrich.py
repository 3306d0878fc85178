"""The enrich operator family.

``enrich`` is a composite-key, exact-equality, left-outer, first-match-only
lookup: every feed row comes out exactly once (no fan-out, R10), reference
rows are reduced to one per key by a deterministic tie-break (R9/H8), and only
the targets the feed lacks are appended under display names (R12, R14).

Physical shape (what ``explain`` shows):

* reference side: scan pruned to keys + missing targets + tie-break columns,
  ``IsNotNull`` on keys pushed to the scan, a broadcast semi-join with the
  feed's distinct keys when the reference is much larger than that key set and
  the key set's measured size fits the broadcast threshold, then
  ``row_number() = 1`` which Spark plans as a partial ``WindowGroupLimit``
  *before* the shuffle (a hot key collapses map-side) and a final one after it;
* feed side: one projection adding the key columns and a validity flag; rows
  with an empty key part never enter a hash bucket together — their join key is
  replaced by a surrogate hashed from the input partition id and the row itself
  (deterministic on task retry) and a residual ``valid`` predicate keeps them
  unmatched, so a third of the feed with blank keys spreads over all tasks
  instead of landing in one;
* the join itself is left to AQE: broadcast when the deduplicated reference is
  small at run time, otherwise sort-merge on the key partitioning the window
  already produced (no second shuffle of the reference), with skew-join splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import c, is_empty
from ..plans.headers import LayoutPlan, check_reference, plan_layout
from ..spec import EnrichSpec

_P = "__ks_"  # prefix of internal columns; never part of a result


def _and(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols) if cols else F.lit(True)


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _key_type(feed_types: Sequence[T.DataType], ref_type: T.DataType) -> T.DataType | None:
    """Comparison type of one key part (H3): equal types or numeric pairs compare
    as is (Spark's own numeric widening). Text cells against a numeric reference
    column compare as numbers, as the job's reader parsed such cells ('0123' and
    '12.0' match 123 and 12): as decimals of the column's scale where it is
    exact, as doubles where it is not. Anything else compares as text. No
    combination can fail a cast under ANSI."""
    if all(ft == ref_type or (_numeric(ft) and _numeric(ref_type)) for ft in feed_types):
        return None
    if _numeric(ref_type) and all(isinstance(ft, T.StringType) or _numeric(ft) for ft in feed_types):
        if isinstance(ref_type, T.FractionalType) and not isinstance(ref_type, T.DecimalType):
            return T.DoubleType()
        return T.DecimalType(38, ref_type.scale if isinstance(ref_type, T.DecimalType) else 0)
    return T.StringType()


def _exact(col: Column, ktype: T.DecimalType) -> Column:
    """Text as a decimal of the key's scale, NULL where that would change its
    value: such text equals no key, so it is unmatched, never rounded."""
    text = F.regexp_replace(col, r"\A\s+|\s+\z", "")
    # plain notation: no more places than the scale once trailing zeros are gone
    plain = text.rlike(rf"\A[+-]?[0-9]+(?:\.[0-9]{{0,{ktype.scale}}}0*)?\z|\A[+-]?\.[0-9]{{0,{ktype.scale}}}0*\z")
    value = text.try_cast(ktype)
    # exponents: digits and places may be anywhere, so compare at a double's precision and beyond it not at all
    other = text.rlike("[eE]") & (value.cast("double") == text.try_cast("double")) & (F.abs(value) < 2 ** 53)
    return F.when(plain | other, value)


def _as(col: Column, src: T.DataType, ktype: T.DataType | None) -> Column:
    if ktype is None or src == ktype:
        return col
    if isinstance(ktype, T.DecimalType) and isinstance(src, T.StringType):
        return _exact(col, ktype)
    if isinstance(ktype, (T.DecimalType, T.DoubleType)):
        return col.try_cast(ktype)
    return col.cast(ktype)


def order_columns(names: Sequence[str]) -> list[Column]:
    """'col' -> ascending NULLS FIRST, '-col' -> descending NULLS LAST."""
    out = []
    for n in names:
        if isinstance(n, Column):
            out.append(n)
        elif n.startswith("-"):
            out.append(c(n[1:]).desc_nulls_last())
        else:
            out.append(c(n).asc_nulls_first())
    return out


def plan_size_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a plan (an upper bound for file scans)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # pragma: no cover - non-classic sessions
        return 1 << 62


def _bytes_conf(spark, key: str, default: str) -> int:
    raw = str(spark.conf.get(key, default) or default).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20),
                      ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return 10 << 20


def broadcast_threshold(spark) -> int:
    """Largest relation this library broadcasts on purpose: the adaptive
    (run-time, measured) threshold when set, else the static one; 10 MB if
    both are off."""
    static = _bytes_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "10485760")
    adaptive = _bytes_conf(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", str(static))
    for v in (adaptive, static):
        if v >= 0:
            return v
    return 10 << 20


# ---------------------------------------------------------------------------
# first row per key
# ---------------------------------------------------------------------------

def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``row_number() = 1`` per key: planned as partial + final WindowGroupLimit."""
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*order)
    rn = _P + "rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def first_per_key(reference: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                  columns: Sequence[str] | None = None) -> DataFrame:
    """One reference row per composite key: the first by ``order_by`` then by
    the remaining selected columns (deterministic, H8). NULL keys never match
    (R8) and are dropped before the shuffle."""
    keys = list(keys)
    if columns is None:
        columns = [n for n in reference.columns if n not in keys]
    columns = [n for n in columns if n not in keys]
    order_names = [o.lstrip("-") for o in order_by if isinstance(o, str)]
    tie = order_columns(list(order_by)) + [c(n).asc_nulls_first() for n in columns if n not in order_names]
    base = reference.select(*[c(n) for n in dict.fromkeys(keys + list(columns) + order_names)])
    base = base.filter(_and([c(k).isNotNull() for k in keys]))
    return _first_rows(base, keys, tie).select(*[c(n) for n in keys + list(columns)])


# ---------------------------------------------------------------------------
# enrich (E1-E3, C5-C9)
# ---------------------------------------------------------------------------

@dataclass
class Prepared:
    plan: LayoutPlan
    feed: DataFrame          # feed columns + __ks_f{i} + __ks_v
    key_cols: list[str]      # __ks_f{i}
    ref_exprs: list[Column]  # reference key expressions in comparison type
    n_keys: int


def _key_exprs(feed_schema: T.StructType, plan: LayoutPlan, reference_schema: T.StructType):
    """Per key: the feed-side expression (alias choice R3/R4, comparison type
    H3), its type, and the matching reference-side expression."""
    fschema = {f.name: f.dataType for f in feed_schema.fields}
    rschema = {f.name: f.dataType for f in reference_schema.fields}
    exprs, types, ref_exprs = [], [], []
    for k, srcs in zip(plan.keys, plan.sources):
        ktype = _key_type([fschema[s] for s in srcs], rschema[k])
        parts = [_as(c(s), fschema[s], ktype) for s in srcs]
        ptypes = [fschema[s] if ktype is None else ktype for s in srcs]
        if len(parts) == 1:
            expr, etype = parts[0], ptypes[0]
        else:  # coalesce_aliases: first non-empty alias cell
            expr = F.coalesce(*[F.when(~is_empty(p, t), p) for p, t in zip(parts, ptypes)])
            etype = ptypes[0]
        exprs.append(expr)
        types.append(etype)
        ref_exprs.append(_as(c(k), rschema[k], ktype))
    return exprs, types, ref_exprs


def prepare(feed: DataFrame, reference_schema: T.StructType, spec: EnrichSpec,
            plan: LayoutPlan | None = None) -> Prepared:
    """Key columns and validity flag on the feed."""
    plan = plan or plan_layout(feed.columns, spec)
    key_exprs, key_types, ref_exprs = _key_exprs(feed.schema, plan, reference_schema)
    valid = ~reduce(lambda a, b: a | b, [is_empty(e, t) for e, t in zip(key_exprs, key_types)])
    # Rows with an empty key part: the key columns get a surrogate so they
    # spread over all join tasks (a blank/NULL key would otherwise hash to a
    # single partition); the residual ``valid`` predicate keeps them unmatched.
    # All columns do, as the optimizer may drop one that is constant in the
    # reference from the join keys.
    hashable = [c(f.name) for f in feed.schema.fields if not isinstance(f.dataType, T.MapType)]
    cols = []
    for i, (e, t) in enumerate(zip(key_exprs, key_types)):
        if isinstance(t, _SPREADS):
            e = F.when(valid, e).otherwise(_surrogate(t, hashable))
        cols.append(e.alias(f"{_P}f{i}"))
    prepared = feed.select(*[c(n) for n in feed.columns], *cols, valid.alias(_P + "v"))
    return Prepared(plan, prepared, [f"{_P}f{i}" for i in range(len(plan.keys))], ref_exprs, len(plan.keys))


_SPREADS = (T.StringType, T.LongType, T.IntegerType, T.DecimalType, T.DoubleType, T.FloatType, T.TimestampType, T.TimestampNTZType,
            T.DateType, T.ShortType)


def _surrogate(t: T.DataType, row_cols: Sequence[Column]) -> Column:
    """Join key for a row that can never match. Deterministic on task retry
    (input partition id + the row's own values, no dependence on row order),
    so a re-run map task sends every row to the same reducer as before;
    identical rows of one input split share a reducer, bounded by the split.
    It may equal a real key: the residual ``valid`` predicate keeps it apart."""
    rid = F.xxhash64(F.spark_partition_id(), *row_cols)
    if isinstance(t, T.StringType):
        return F.concat(F.lit("\u0000"), rid.cast("string"))
    if isinstance(t, T.LongType):
        return rid
    if isinstance(t, T.DecimalType):
        return F.pmod(rid, F.lit(10 ** min(18, max(1, t.precision - t.scale)))).try_cast(t)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.pmod(rid, F.lit(4_000_000_000))).cast(t)
    if isinstance(t, T.DateType):
        return F.date_from_unix_date(F.pmod(rid, F.lit(1_000_000)).cast("int"))
    if isinstance(t, T.ShortType):
        return F.pmod(rid, F.lit(32767)).cast(t)
    if isinstance(t, T.IntegerType):
        return F.pmod(rid, F.lit(2147483647)).cast("int")
    return F.pmod(rid, F.lit(1 << 52)).cast(t)


_FIXED_WIDTH = {T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.IntegerType: 4,
                T.FloatType: 4, T.DateType: 4, T.ShortType: 2, T.ByteType: 1, T.BooleanType: 1}


def _key_bytes(keys_df: DataFrame) -> int:
    """Exact in-memory size bound of a (small) key set: one aggregate over it."""
    sizes = []
    for f in keys_df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            sizes.append(F.coalesce(F.octet_length(col), F.lit(0)) + F.lit(8))
        else:
            sizes.append(F.lit(_FIXED_WIDTH.get(type(f.dataType), 16)))
    row = reduce(lambda a, b: a + b, sizes) + F.lit(16)   # + row header
    got = keys_df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("b")).first()["b"]
    return int(got)


REDUCE_RATIO = 8   # reduce only when the reference is this many times the key set


def _reduce_decision(mode, keys_df: DataFrame, ref_df: DataFrame | None = None) -> bool:
    """Semi-join reduction only where it pays: when the distinct feed keys are
    small enough to broadcast *before* the reference is shuffled, and the
    reference is much larger than they are (a small feed against a big table;
    with comparable sizes the final join alone is cheaper). The optimizer's
    estimates decide those without a job; only then is the key set's exact
    size measured, so the broadcast that follows has a proven bound."""
    if mode is True or mode is False:
        return mode
    if mode != "auto":
        raise ValueError("reduce_reference must be True, False, 'bitmap' or 'auto'")
    limit = broadcast_threshold(keys_df.sparkSession)
    keys_est = plan_size_bytes(keys_df)
    if keys_est > 4 * limit:   # estimates come from compressed files: keep a margin
        return False
    if ref_df is not None and plan_size_bytes(ref_df) < REDUCE_RATIO * keys_est:
        return False
    return _key_bytes(keys_df) <= limit


#: Bits of the key bitmap: its broadcast is a fixed 8 MiB, in rows of 4 KiB.
BITMAP_BITS = 1 << 26


def bitmap_reduce(ref: DataFrame, rkeys: Sequence[str], feed_keys: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """``ref`` without most rows whose key is not in ``feed_keys`` (D3), for key
    sets too large to broadcast: the keys' hashes are set in a bitmap of fixed
    size, merged per part of it, and each reference row's bit is tested before
    anything of the reference is shuffled. Rows that stay by a shared bit find
    no feed row in the join that follows."""
    at = F.pmod(F.xxhash64(*[F.col(k) for k in rkeys]), F.lit(bits))
    per = min(bits, 32768)   # bits of one row, as bitmap_bit_position counts them
    parts = (feed_keys.select(at.alias("at")).select(F.floor(F.col("at") / per).cast("long").alias(f"{_P}part"), F.pmod("at", F.lit(per)).alias("bit"))
             .groupBy(f"{_P}part").agg(F.bitmap_construct_agg("bit").alias(f"{_P}bits")))
    parts = F.broadcast(parts)   # bits / 8 bytes in all
    found = ref.withColumn(f"{_P}at", at).withColumn(f"{_P}part", F.floor(F.col(f"{_P}at") / per).cast("long")).join(parts, f"{_P}part")
    bit = F.pmod(F.col(f"{_P}at"), F.lit(per))
    byte = F.conv(F.hex(F.substring(F.col(f"{_P}bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    return found.where(is_set).select(*[c(n) for n in ref.columns])


def _bitmap_pays(keys_df: DataFrame, ref_df: DataFrame, bits: int = BITMAP_BITS) -> bool:
    """By the optimizer's estimates: the reference is far larger than the key
    set, and the key set (16 bytes a key at least) leaves most bits unset."""
    keys = plan_size_bytes(keys_df)
    return plan_size_bytes(ref_df) >= REDUCE_RATIO * keys and keys / 16 <= bits / 4


def first_reference(reference: DataFrame, spec: EnrichSpec, ref_exprs: Sequence[Column],
                    targets: Sequence[str], feed_keys: DataFrame | None = None,
                    reduce_reference="auto", reduced: list | None = None) -> DataFrame:
    """Pruned, NULL-free, optionally semi-joined, first-per-key reference with
    columns ``__ks_r{i}`` (keys in comparison type), ``__ks_t{j}`` (``targets``
    in order) and ``__ks_m`` (match indicator). ``feed_keys`` (columns
    ``__ks_r{i}``, distinct) drives the optional semi-join reduction, of which
    ``reduced`` is told (True) where it takes place."""
    order_names = [o.lstrip("-") for o in spec.order_by]
    # beyond order_by the tie-break runs over all targets of the spec, not only
    # those that this feed lacks: the choice must not depend on the feed
    ties = [t for t in spec.target_columns if t in reference.columns and t not in order_names]
    rkeys = [f"{_P}r{i}" for i in range(len(ref_exprs))]
    ref = reference.select(
        *[e.alias(k) for e, k in zip(ref_exprs, rkeys)],
        *[c(t).alias(f"{_P}t{j}") for j, t in enumerate(targets)],
        *[c(o).alias(f"{_P}o{m}") for m, o in enumerate(order_names)],
        *[c(t).alias(f"{_P}x{m}") for m, t in enumerate(ties)],
    ).filter(_and([F.col(k).isNotNull() for k in rkeys]))
    if feed_keys is not None:
        whole = ref
        if reduce_reference == "auto" and _reduce_decision("auto", feed_keys, ref):
            ref = ref.join(F.broadcast(feed_keys), on=rkeys, how="left_semi")   # size measured above
        elif reduce_reference == "bitmap" or (reduce_reference == "auto" and _bitmap_pays(feed_keys, ref)):
            ref = bitmap_reduce(ref, rkeys, feed_keys)
        elif reduce_reference is True:
            ref = ref.join(feed_keys, on=rkeys, how="left_semi")                # strategy left to AQE
        if reduced is not None and ref is not whole:
            reduced.append(True)
    order = []
    for m, o in enumerate(spec.order_by):
        col = F.col(f"{_P}o{m}")
        order.append(col.desc_nulls_last() if o.startswith("-") else col.asc_nulls_first())
    order += [F.col(f"{_P}x{m}").asc_nulls_first() for m in range(len(ties))]
    if not order:
        order = [F.lit(1)]
    first = _first_rows(ref, rkeys, order)
    return first.select(*rkeys, *[f"{_P}t{j}" for j in range(len(targets))], F.lit(True).alias(_P + "m"))


def feed_key_set(prep: Prepared) -> DataFrame:
    """Distinct valid keys of a prepared feed, named like the reference side."""
    return prep.feed.filter(F.col(_P + "v")).select(
        *[F.col(f).alias(f"{_P}r{i}") for i, f in enumerate(prep.key_cols)]).distinct()


def reference_side(prep: Prepared, reference: DataFrame, spec: EnrichSpec,
                   reduce_reference="auto") -> DataFrame:
    """The first-per-key reference for one feed: its missing targets only."""
    missing = [col for col, _ in prep.plan.missing]
    check_reference(reference.columns, prep.plan.keys, missing, spec.order_by)
    return first_reference(reference, spec, prep.ref_exprs, missing, feed_key_set(prep), reduce_reference)


@dataclass
class SharedReference:
    """A first-per-key reference built once and joined by many feeds (all
    layouts of a run with the same keys and key comparison types)."""
    frame: DataFrame
    targets: tuple[str, ...]
    broadcast: bool = False   # set only from the materialised (measured) size
    whole: bool = False       # not reduced to the keys of the feeds that were known


def reference_signature(feed_schema: T.StructType, plan: LayoutPlan, reference_schema: T.StructType) -> tuple:
    """Layouts with equal signatures can share one first-per-key reference."""
    _, _, ref_exprs = _key_exprs(feed_schema, plan, reference_schema)
    return (plan.keys, tuple(str(e) for e in ref_exprs))


def enrich(feed: DataFrame, reference: DataFrame, spec: EnrichSpec, *, reduce_reference="auto",
           flag: str | None = None, plan: LayoutPlan | None = None,
           shared: SharedReference | None = None, prepared: Prepared | None = None) -> DataFrame:
    """Append the reference's missing target columns to every feed row.

    Raises :class:`~keystitch.plans.headers.NoKeyColumns` when no key
    combination is present (R5). With nothing missing the feed is returned
    unchanged and the reference is never scanned (C5, R13). ``flag`` names an
    optional boolean match-indicator column (E3, R11). ``shared`` is a
    first-per-key reference built once for many feeds (see the directory job)."""
    plan = plan or plan_layout(feed.columns, spec)
    if plan.passthrough:
        return feed
    prep = prepared or prepare(feed, reference.schema, spec, plan)
    if feed.isStreaming:   # stream-static join: the static side is reduced per key only
        reduce_reference = False
    missing = [col for col, _ in plan.missing]
    if shared is None:
        ref = reference_side(prep, reference, spec, reduce_reference)
        tcols = [f"{_P}t{j}" for j in range(len(missing))]
    else:
        tcols = [f"{_P}t{shared.targets.index(t)}" for t in missing]
        ref = shared.frame.select(*[f"{_P}r{i}" for i in range(prep.n_keys)], *tcols, _P + "m")
        if shared.broadcast:
            ref = F.broadcast(ref)
    cond = _and([F.col(f) == F.col(f"{_P}r{i}") for i, f in enumerate(prep.key_cols)]) & F.col(_P + "v")
    joined = prep.feed.join(ref, on=cond, how="left")
    out = [c(n) for n in feed.columns]
    out += [F.col(t).alias(name) for t, name in zip(tcols, plan.appended)]
    if flag:
        out.append(F.coalesce(F.col(_P + "m"), F.lit(False)).alias(flag))
    return joined.select(*out)


# ---------------------------------------------------------------------------
# filters and set-style joins
# ---------------------------------------------------------------------------

def key_frame(feed: DataFrame, spec: EnrichSpec, reference_schema: T.StructType | None = None,
              names: Sequence[str] | None = None) -> DataFrame:
    """Feed with its composite key as columns named after the canonical keys
    (or ``names``) plus ``key_valid`` (D2). Without a reference schema the keys
    keep the feed's types. A key name that already is a feed column gets the
    suffix ``__key``."""
    plan = plan_layout(feed.columns, spec)
    plain = prepare_plain(feed, plan, reference_schema or _feed_key_schema(feed, plan))
    taken = set(feed.columns)
    out_names = []
    for nm in (names or plan.keys):
        while nm in taken:
            nm = nm + "__key"
        taken.add(nm)
        out_names.append(nm)
    return plain.select(*[c(n) for n in feed.columns],
                        *[F.col(f"{_P}p{i}").alias(nm) for i, nm in enumerate(out_names)],
                        F.col(_P + "v").alias("key_valid" if "key_valid" not in feed.columns else "key_valid__key"))


def prepare_plain(feed: DataFrame, plan: LayoutPlan, schema: T.StructType) -> DataFrame:
    """Feed + raw key columns ``__ks_p{i}`` + validity ``__ks_v`` (no surrogate)."""
    exprs, types, _ = _key_exprs(feed.schema, plan, schema)
    valid = ~reduce(lambda a, b: a | b, [is_empty(e, t) for e, t in zip(exprs, types)])
    return feed.select(*[c(n) for n in feed.columns],
                       *[e.alias(f"{_P}p{i}") for i, e in enumerate(exprs)], valid.alias(_P + "v"))


def missing_key_rows(feed: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Feed rows with at least one empty key part (D2): never looked up."""
    plan = plan_layout(feed.columns, spec)
    plain = prepare_plain(feed, plan, _feed_key_schema(feed, plan))
    return plain.filter(~F.col(_P + "v")).select(*[c(n) for n in feed.columns])


def _feed_key_schema(feed: DataFrame, plan: LayoutPlan) -> T.StructType:
    ftypes = {f.name: f.dataType for f in feed.schema.fields}
    return T.StructType([T.StructField(k, ftypes[s[0]]) for k, s in zip(plan.keys, plan.sources)])


def distinct_keys(feed: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Distinct valid composite keys of a feed (F1), named by canonical key."""
    plan = plan_layout(feed.columns, spec)
    plain = prepare_plain(feed, plan, _feed_key_schema(feed, plan))
    return plain.filter(F.col(_P + "v")).select(
        *[F.col(f"{_P}p{i}").alias(k) for i, k in enumerate(plan.keys)]).distinct()


def reference_semi(feed: DataFrame, reference: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Reference rows whose key occurs among the feed's valid keys (D3): the
    relational form of the reference's composite ``IN`` filter."""
    plan = plan_layout(feed.columns, spec)
    plain = prepare_plain(feed, plan, reference.schema)
    keys = plain.filter(F.col(_P + "v")).select(
        *[F.col(f"{_P}p{i}").alias(f"{_P}k{i}") for i in range(len(plan.keys))]).distinct()
    _, _, ref_exprs = _key_exprs(feed.schema, plan, reference.schema)
    cond = [rk == F.col(f"{_P}k{i}") for i, rk in enumerate(ref_exprs)]
    return reference.join(keys, on=_and(cond), how="left_semi")


def reference_semi_bitmap(feed: DataFrame, reference: DataFrame, spec: EnrichSpec, bits: int = BITMAP_BITS) -> DataFrame:
    """:func:`reference_semi` for key sets beyond the broadcast bound: the
    bitmap drops most other rows before the reference is shuffled for the
    exact semi-join."""
    plan = plan_layout(feed.columns, spec)
    prep = prepare(feed, reference.schema, spec, plan)
    rkeys = [f"{_P}r{i}" for i in range(prep.n_keys)]
    keys = feed_key_set(prep)
    ref = reference.select("*", *[e.alias(k) for e, k in zip(prep.ref_exprs, rkeys)]).where(_and([F.col(k).isNotNull() for k in rkeys]))
    return bitmap_reduce(ref, rkeys, keys, bits).join(keys, on=rkeys, how="left_semi").select(*[c(n) for n in reference.columns])


def _by_key(feed: DataFrame, reference: DataFrame, spec: EnrichSpec, how: str) -> DataFrame:
    """Semi or anti join on the keys alone: of the reference only the key
    columns are read, and nothing is reduced to first rows."""
    plan = plan_layout(feed.columns, spec)
    check_reference(reference.columns, plan.keys, [], [])
    prep = prepare(feed, reference.schema, spec, plan)
    rkeys = [f"{_P}r{i}" for i in range(prep.n_keys)]
    keys = reference.select(*[e.alias(k) for e, k in zip(prep.ref_exprs, rkeys)]).filter(
        _and([F.col(k).isNotNull() for k in rkeys]))
    cond = _and([F.col(f) == F.col(r) for f, r in zip(prep.key_cols, rkeys)]) & F.col(_P + "v")
    return prep.feed.join(keys, on=cond, how=how).select(*[c(n) for n in feed.columns])


def matched(feed: DataFrame, reference: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Feed rows whose key has a reference row (E5), feed columns only."""
    return _by_key(feed, reference, spec, "left_semi")


def unmatched(feed: DataFrame, reference: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Feed rows without a reference row, including rows with an empty key."""
    return _by_key(feed, reference, spec, "left_anti")


def match_stats(enriched: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    """Match / no-match counters (F3), optionally per group (file, sheet, ...)."""
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.count_if(c(flag)).alias("matched"),
            F.count_if(~c(flag)).alias("unmatched")]
    if by:
        return enriched.groupBy(*[c(b) for b in by]).agg(*aggs)
    return enriched.agg(*aggs)


def where_key(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Conjunctive equality filter from a column -> value mapping."""
    return df.filter(_and([c(k) == F.lit(v) for k, v in values.items()]))
