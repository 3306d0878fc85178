"""Kept reference, key bitmap and lease."""

import time

import pytest
from pyspark.sql import functions as F

from keystitch import EnrichSpec, enrich
from keystitch.operators.enrich import _P, bitmap_reduce, feed_key_set, first_reference, prepare, reference_semi, reference_semi_bitmap
from keystitch.operators.kept import KeptReference
from keystitch.plans.headers import plan_layout
from keystitch.sources.files import hadoop_delete, hadoop_glob, hadoop_mkdirs, hadoop_write_text
from keystitch.streaming.incremental import run_once
from keystitch.streaming.lease import AlreadyRunning, Lease

SPEC = EnrichSpec(order_by=("-Booking_Date", "Invoice_Number")).with_targets(["Taxable_Amount", "Booking_Date", "Invoice_Number"])
SCHEMA = "PNR_Number bigint, Airline_Code bigint, Travel_Sector string, Taxable_Amount double, Booking_Date string, Invoice_Number string"


def some(spark, lo, hi, day, parts=2):
    rows = [(k % 50, 2, None if k % 17 == 0 else "A", float(k), None if k % 5 == 0 else f"{day}{k % 3}", f"i{k % 4}") for k in range(lo, hi)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def joined(spark, kept, reference, feed):
    plan = plan_layout(feed.columns, SPEC)
    prep = prepare(feed, reference.schema, SPEC, plan)
    shared = None if kept is None else kept.shared(reference, SPEC, prep.ref_exprs, [n for n, _ in plan.missing])
    return enrich(feed, reference, SPEC, plan=plan, shared=shared, prepared=prep)


@pytest.fixture
def feed(spark):
    return spark.createDataFrame([(k, 2, "A") for k in range(60)], '`Airline PNR` bigint, `Airline Code` bigint, Sector string')


def rows(df):
    return sorted(map(str, df.collect()))


def test_kept_reference_follows_the_files(spark, scratch, feed):
    src, kept = f"{scratch}/ref", KeptReference(f"{scratch}/kept", buckets=4)
    for i, (lo, hi, day) in enumerate([(0, 300, "b"), (300, 420, "c"), (0, 120, "a")]):   # later files win some keys and lose others
        some(spark, lo, hi, day).write.mode("append").parquet(src)
        ref = spark.read.parquet(src)
        assert rows(joined(spark, kept, ref, feed)) == rows(joined(spark, None, ref, feed)), i
    states = len(hadoop_glob(spark, f"{scratch}/kept/*/*/_SUCCESS"))
    assert rows(joined(spark, kept, spark.read.parquet(src), feed)) and len(hadoop_glob(spark, f"{scratch}/kept/*/*/_SUCCESS")) == states == 3
    for part in hadoop_glob(spark, f"{src}/part-*")[:2]:   # files went: built anew
        hadoop_delete(spark, part)
    ref = spark.read.parquet(src)
    assert rows(joined(spark, kept, ref, feed)) == rows(joined(spark, None, ref, feed))


def test_unchanged_reference_is_neither_ranked_nor_shuffled(spark, scratch, feed):
    src, kept = f"{scratch}/ref", KeptReference(f"{scratch}/kept", buckets=4)
    some(spark, 0, 300, "b").write.parquet(src)
    joined(spark, kept, spark.read.parquet(src), feed).collect()
    for t in [t.name for t in spark.catalog.listTables() if t.name.startswith("ks_kept_")]:   # another session knows no table
        spark.sql(f"DROP TABLE {t}")
    saved = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = joined(spark, kept, spark.read.parquet(src), feed)
        got = rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", saved)
    assert got == rows(joined(spark, None, spark.read.parquet(src), feed))
    assert "SortMergeJoin" in plan and "Window" not in plan and plan.count("Exchange hashpartitioning") == 1   # the feed's


def test_bitmap_keeps_every_match_and_drops_most_others(spark, feed):
    ref = some(spark, 0, 500, "b").withColumn("PNR_Number", F.col("Taxable_Amount").cast("bigint"))
    prep = prepare(feed, ref.schema, SPEC, plan_layout(feed.columns, SPEC))
    keyed = ref.select("*", *[e.alias(f"{_P}r{i}") for i, e in enumerate(prep.ref_exprs)]).where("Travel_Sector is not null")
    rk = [f"{_P}r{i}" for i in range(3)]
    left = bitmap_reduce(keyed, rk, feed_key_set(prep), bits=1 << 16)
    want = {r.PNR_Number for r in keyed.collect() if r.PNR_Number < 60}
    got = {r.PNR_Number for r in left.collect()}
    assert want <= got and len(got) < len(want) + 10
    for bits in (8, 64, 1 << 20):   # shared bits cost rows, never matches
        assert rows(reference_semi_bitmap(feed, ref, SPEC, bits)) == rows(reference_semi(feed, ref, SPEC))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    a = first_reference(ref, SPEC, prep.ref_exprs, ["Taxable_Amount"], feed_key_set(prep), "bitmap")
    b = first_reference(ref, SPEC, prep.ref_exprs, ["Taxable_Amount"], feed_key_set(prep), True)
    assert set(rows(b)) <= set(rows(a)) and len(rows(a)) < 80


def test_bitmap_shrinks_the_reference_shuffle(spark, scratch, feed):
    """Rows that reach the ranking's shuffle, without the bitmap and with it."""
    src = f"{scratch}/big"
    spark.range(200_000).select(F.col("id").alias("PNR_Number"), F.lit(2).cast("bigint").alias("Airline_Code"), F.lit("A").alias("Travel_Sector"),
                                F.rand(1).alias("Taxable_Amount"), F.lit("d").alias("Booking_Date"), F.lit("i").alias("Invoice_Number")).write.parquet(src)
    ref = spark.read.parquet(src)
    prep = prepare(feed, ref.schema, SPEC, plan_layout(feed.columns, SPEC))
    n = {}
    for mode in (False, "bitmap"):
        df = first_reference(ref, SPEC, prep.ref_exprs, ["Taxable_Amount"], feed_key_set(prep), mode)
        n[mode] = df.count()
    assert n[False] == 200_000 and 60 <= n["bitmap"] < 400


def test_lease(spark, scratch):
    path = f"{scratch}/lease/run"
    with Lease(spark, path, seconds=0.6) as mine:
        with pytest.raises(AlreadyRunning):
            Lease(spark, path).acquire()
        time.sleep(1.5)   # renewed meanwhile
        with pytest.raises(AlreadyRunning):
            Lease(spark, path).acquire()
        assert mine.holder()["owner"] == mine.owner
    assert Lease(spark, path).holder() is None
    dead = Lease(spark, path, seconds=-1).acquire()
    new = Lease(spark, path).acquire()   # taken over
    dead.release()                        # not its own any more
    assert new.holder()["owner"] == new.owner
    with pytest.raises(AlreadyRunning):
        dead.renew()
    new.renew()
    new.release()
    assert new.holder() is None


def test_one_of_many_contenders_gets_the_lease(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    path = f"{scratch}/lease/race"
    for stale in (False, True):
        if stale:
            Lease(spark, path, seconds=-1).acquire()

        def attempt(_):
            try:
                return Lease(spark, path, seconds=60).acquire()
            except AlreadyRunning:
                return None
        with ThreadPoolExecutor(8) as pool:
            won = [x for x in pool.map(attempt, range(8)) if x]
        assert len(won) == 1
        won[0].release()


def test_a_run_elsewhere_keeps_this_one_out(spark, scratch):
    inbox = f"{scratch}/inbox"
    hadoop_mkdirs(spark, inbox)
    hadoop_write_text(spark, f"{inbox}/a.csv", "Airline PNR,Airline Code,Sector\n1,2,A\n")
    ref = some(spark, 0, 50, "b")
    other = Lease(spark, f"{scratch}/ckpt_lease/run").acquire()
    with pytest.raises(AlreadyRunning):
        run_once(spark, inbox, ref, SPEC, f"{scratch}/out", f"{scratch}/ckpt")
    other.release()
    run_once(spark, inbox, ref, SPEC, f"{scratch}/out", f"{scratch}/ckpt", kept=f"{scratch}/keptref")
    assert Lease(spark, f"{scratch}/ckpt_lease/run").holder() is None
    assert spark.read.option("header", True).csv(f"{scratch}/out").count() == 1
