"""Physical-plan checks: pruning, pushdown, map-side first-per-key, no Python
on the enrich path, one reference shuffle."""
import io
from contextlib import redirect_stdout

import pytest

from keystitch import fixtures as X
from keystitch import enrich

SF = "/root/testdata/sf0.001"


def plan_text(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(df):
    """Shuffles of the initial plan."""
    text = plan_text(df)
    tree = text[text.index("+- == Initial Plan ==") if "+- == Initial Plan ==" in text else 0:].split("\n\n")[0]
    return sum(line.strip(" :+-*").startswith("Exchange") for line in tree.splitlines())


def test_enrich_plan_shape(spark):
    feed, ref = X.x1_feed(spark, SF), X.x1_reference(spark, SF)
    text = plan_text(enrich(feed, ref, X.x1_spec(ref), reduce_reference=False))
    assert "WindowGroupLimit" in text and "Partial" in text           # map-side first-per-key
    assert "IsNotNull(l_orderkey)" in text                              # NULL keys never shuffled
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_extendedprice:double,l_discount:double,l_tax:double,l_returnflag:string," \
           "l_linestatus:string,l_shipdate:timestamp_ntz>" in text
    schemas = [ln for ln in text.splitlines() if ln.startswith("ReadSchema:")]
    ref_schema = next(ln for ln in schemas if "l_extendedprice" in ln)
    assert "l_quantity" not in ref_schema                               # reference pruned
    feed_schema = next(ln for ln in schemas if "l_extendedprice" not in ln)
    assert "l_shipdate" not in feed_schema                              # feed pruned
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert exchanges(enrich(feed, ref, X.x1_spec(ref), reduce_reference=False)) == 2   # one shuffle per side


def test_small_feed_reduces_reference_before_shuffle(spark):
    """A feed much smaller than the reference: its measured key set is
    broadcast into the reference scan before the window shuffle."""
    from pyspark.sql import functions as F
    ref = X.x1_reference(spark, SF)
    feed = X.table(spark, SF, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("Airline PNR"), F.lit(1).alias("Airline Code"),
        F.lit("N").alias("Sector"))
    text = plan_text(enrich(feed, ref, X.x1_spec(ref)))
    assert "LeftSemi" in text and "BroadcastExchange" in text


def test_comparable_sizes_skip_the_reduction(spark):
    feed, ref = X.x1_feed(spark, SF), X.x1_reference(spark, SF)
    assert "LeftSemi" not in plan_text(enrich(feed, ref, X.x1_spec(ref)))


def test_passthrough_never_scans_reference(spark):
    from keystitch.spec import EnrichSpec
    feed = X.x1_feed(spark, SF)
    cols = [feed[c] for c in ["l_partkey"]]
    full = feed.select("*", *[cols[0].alias(t) for t, _ in EnrichSpec().targets])
    out = enrich(full, X.x1_reference(spark, SF), EnrichSpec(order_by=X.X1_ORDER_BY))
    assert out is full and "l_extendedprice" not in plan_text(out)


def test_hot_feed_key_is_split_by_aqe(spark):
    """A third of the feed on one valid key: the sort-merge join's hot
    partition is split by AQE (the reference side is unique per key)."""
    from pyspark.sql import functions as F

    from keystitch import EnrichSpec
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        feed = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("K1"),
                                     F.lit(1).cast("bigint").alias("K2"), "id")
        ref = spark.range(n).select(F.col("id").alias("K1"), F.lit(1).cast("bigint").alias("K2"),
                                    (F.col("id") * 2.0).alias("T"), F.lit(0).alias("O"))
        spec = EnrichSpec(key_combinations=[("K1", "K2")], aliases=[], targets=[("T", "T")], order_by=("O",))
        out = enrich(feed, ref, spec, reduce_reference=False)
        rows = out.collect()
        assert len(rows) == n
        hot = [r for r in rows if r["K1"] == 7]
        assert len(hot) == n // 3 + 1 and all(r["T"] == 14.0 for r in hot)
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


JOIN_ONLY = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false"}


@pytest.mark.parametrize("kind", ["string", "bigint", "decimal(12,2)", "double", "date", "timestamp"])
def test_blank_keys_spread_over_reducers(spark, scratch, kind):
    """Blank keys read from files (text cells), against reference keys of each
    type: no join task gets more than twice the mean, and they stay unmatched."""
    from pyspark.sql import functions as F

    from keystitch import EnrichSpec
    from keystitch.operators.enrich import prepare
    from keystitch.session import job_settings
    # rows differ in another column, as rows of a feed do
    spark.range(0, 8000, 1, 8).select(F.lit(" ").alias("K1"), F.lit("1").alias("K2"), F.col("id").cast("string").alias("row")
                                      ).write.parquet(f"{scratch}/feed")
    with job_settings(spark, **JOIN_ONLY):
        feed = spark.read.parquet(f"{scratch}/feed")
        key = F.col("id").cast("string") if kind == "string" else F.col("id").cast("int").cast(kind) if kind not in ("date", "timestamp") \
            else F.timestamp_seconds("id").cast(kind)
        ref = spark.range(100).select(key.alias("K1"), F.lit(1).cast("bigint").alias("K2"), F.lit(1.0).alias("T"), F.lit(0).alias("O"))
        spec = EnrichSpec(key_combinations=[("K1", "K2")], aliases=[], targets=[("T", "T")], order_by=("O",))
        out = enrich(feed, ref, spec, flag="m", reduce_reference=False)
        assert exchanges(out) == 2
        per = out.select("m", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n"), F.count_if("m").alias("hits")).collect()
        assert sum(r["n"] for r in per) == 8000 and not any(r["hits"] for r in per)
        assert len(per) == 8 and max(r["n"] for r in per) <= 2 * 1000
        stream = spark.readStream.schema(feed.schema).parquet(f"{scratch}/feed")
        key_col = prepare(stream, ref.schema, spec).feed.select("__ks_f0")   # spread in streams too
        assert "spark_partition_id" in key_col._jdf.queryExecution().toString().lower()


def test_matched_and_unmatched_read_the_keys_only(spark):
    from keystitch.operators.enrich import matched, unmatched
    feed, ref = X.x1_feed(spark, SF), X.x1_reference(spark, SF)
    for how in (matched, unmatched):
        text = plan_text(how(feed, ref, X.x1_spec(ref)))
        assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_linestatus:string>" in text or "l_extendedprice" not in text
        assert "Window" not in text and "l_extendedprice" not in text and "l_shipdate" not in text
    n = feed.count()
    assert matched(feed, ref, X.x1_spec(ref)).count() + unmatched(feed, ref, X.x1_spec(ref)).count() == n


def test_sheet_union_reads_its_tables_once(spark):
    from keystitch.catalog import QUERIES
    text = plan_text(QUERIES["sheet_union"](spark, SF))
    assert text.count("ReadSchema:") == 2
