"""Enrich semantics on tiny frames."""
from keystitch import EnrichSpec, enrich, first_per_key, matched, match_stats, unmatched
from keystitch.operators.enrich import distinct_keys, missing_key_rows

SPEC = EnrichSpec(key_combinations=[("K1", "K2")], aliases=[("key one", "K1"), ("key two", "K2")],
                  targets=[("T", "Target"), ("U", "U")], order_by=("O",))


def ref_df(spark, rows):
    return spark.createDataFrame(rows, "K1 string, K2 bigint, T double, U string, O int")


def test_first_match_no_fanout_and_order(spark):
    feed = spark.createDataFrame([("a", 1, 0), ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)],
                                 "`Key One` string, `key two` bigint, id int")
    ref = ref_df(spark, [("a", 1, 10.0, "x", 2), ("a", 1, 11.0, "y", 1), ("b", 2, None, "z", 1)])
    out = enrich(feed, ref, SPEC, flag="m").orderBy("id").collect()
    assert [r["id"] for r in out] == [0, 1, 2, 3]                      # R10: every row once
    assert [r["Target"] for r in out] == [11.0, 11.0, None, None]      # R9: tie-break O
    assert [r["m"] for r in out] == [True, True, True, False]          # R11: NULL target still matched
    assert out[0].asDict().keys() >= {"Key One", "key two", "id", "Target", "U"}


def test_empty_keys_never_match(spark):
    feed = spark.createDataFrame([(" ", 1), (" \t", 1), (None, 1), ("a", None), ("a", 1)],
                                 "K1 string, K2 bigint")
    ref = ref_df(spark, [(" ", 1, 1.0, "s", 1), ("a", 1, 2.0, "t", 1), (None, 1, 3.0, "n", 1)])
    out = enrich(feed, ref, SPEC, flag="m").collect()
    assert sorted((r["K1"], r["m"]) for r in out if r["m"]) == [("a", True)]
    assert len(out) == 5
    assert missing_key_rows(feed, SPEC).count() == 4


def test_raw_exact_comparison(spark):
    feed = spark.createDataFrame([("A", 1), ("a ", 1), ("a", 1)], "K1 string, K2 bigint")
    ref = ref_df(spark, [("a", 1, 1.0, "x", 1)])
    hits = [r["K1"] for r in enrich(feed, ref, SPEC, flag="m").collect() if r["m"]]
    assert hits == ["a"]                                                 # R7: no trim, no case fold


def test_text_key_against_numeric_reference(spark):
    feed = spark.createDataFrame([("a", "1"), ("a", "x")], "K1 string, K2 string")
    ref = ref_df(spark, [("a", 1, 1.0, "x", 1)])
    out = {r["K2"]: r["m"] for r in enrich(feed, ref, SPEC, flag="m").collect()}
    assert out == {"1": True, "x": False}                                # H3: never a cast failure


def test_existing_targets_not_overwritten(spark):
    feed = spark.createDataFrame([("a", 1, "mine")], "K1 string, K2 bigint, U string")
    ref = ref_df(spark, [("a", 1, 1.0, "theirs", 1)])
    out = enrich(feed, ref, SPEC)
    assert out.columns == ["K1", "K2", "U", "Target"]                    # R12, R14
    assert out.first()["U"] == "mine"


def test_header_only_feed_gives_empty_result(spark):
    feed = spark.createDataFrame([], "K1 string, K2 bigint")
    ref = ref_df(spark, [("a", 1, 1.0, "x", 1)])
    out = enrich(feed, ref, SPEC)
    assert out.count() == 0 and out.columns == ["K1", "K2", "Target", "U"]   # R17 deviation


def test_matched_unmatched_partition_the_feed(spark):
    feed = spark.createDataFrame([("a", 1), ("b", 2), (" ", 3), ("a", 1)], "K1 string, K2 bigint")
    ref = ref_df(spark, [("a", 1, 1.0, "x", 1), ("a", 1, 2.0, "x", 0)])
    assert matched(feed, ref, SPEC).count() == 2
    assert unmatched(feed, ref, SPEC).count() == 2
    stats = match_stats(enrich(feed, ref, SPEC, flag="m"), "m").first()
    assert (stats["rows"], stats["matched"], stats["unmatched"]) == (4, 2, 2)
    assert distinct_keys(feed, SPEC).count() == 2


def test_first_per_key_drops_null_keys(spark):
    ref = ref_df(spark, [("a", 1, 1.0, "x", 3), ("a", 1, 2.0, "y", 1), (None, 1, 3.0, "z", 0)])
    rows = first_per_key(ref, ["K1", "K2"], ["O"], ["T"]).collect()
    assert [(r["K1"], r["T"]) for r in rows] == [("a", 2.0)]


def test_reduce_modes_agree(spark):
    feed = spark.createDataFrame([(str(i % 7), i % 3) for i in range(50)], "K1 string, K2 bigint")
    ref = ref_df(spark, [(str(i % 5), i % 3, float(i), "u", i) for i in range(40)])
    a = sorted(map(tuple, enrich(feed, ref, SPEC, reduce_reference=True).collect()), key=repr)
    b = sorted(map(tuple, enrich(feed, ref, SPEC, reduce_reference=False).collect()), key=repr)
    assert a == b


def test_coalesce_aliases_option(spark):
    feed = spark.createDataFrame([(None, "a", 1)], "`key one` string, K1 string, K2 bigint")
    spec = EnrichSpec(key_combinations=[("K1", "K2")], aliases=[("key one", "K1"), ("K1", "K1")],
                      targets=[("T", "Target")], coalesce_aliases=True)
    ref = ref_df(spark, [("a", 1, 5.0, "x", 1)])
    assert enrich(feed, ref, spec).first()["Target"] == 5.0
    strict = EnrichSpec(key_combinations=[("K1", "K2")], aliases=[("key one", "K1"), ("K1", "K1")],
                        targets=[("T", "Target")])
    assert enrich(feed, ref, strict).first()["Target"] is None          # R3: first alias even if empty


def test_overlap_guard(spark, scratch):
    """A second run under the same name while the first is active is refused."""
    import pytest

    from keystitch.sources.files import hadoop_mkdirs
    from keystitch.streaming.incremental import AlreadyRunning, enrich_incremental
    inbox = f"{scratch}/inbox"
    hadoop_mkdirs(spark, inbox)
    ref = ref_df(spark, [("a", 1, 1.0, "x", 1)])
    q = enrich_incremental(spark, inbox, ref, SPEC, f"{scratch}/out", f"{scratch}/ckpt", name="ks_guard",
                           available_now=False, interval="1 hour")
    try:
        with pytest.raises(AlreadyRunning):
            enrich_incremental(spark, inbox, ref, SPEC, f"{scratch}/out", f"{scratch}/ckpt2", name="ks_guard")
    finally:
        q.stop()


def test_text_keys_against_numeric_reference_compare_as_numbers(spark):
    feed = spark.createDataFrame([("a", "0001"), ("a", "1.0"), ("a", " 1 "), ("a", "x1"), ("a", "2")],
                                 "K1 string, K2 string")
    ref = ref_df(spark, [("a", 1, 5.0, "u", 1)])
    got = {r["K2"]: r["m"] for r in enrich(feed, ref, SPEC, flag="m").collect()}
    assert got == {"0001": True, "1.0": True, " 1 ": True, "x1": False, "2": False}
