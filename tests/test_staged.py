"""Staged commit: order, counts, replay, failed files, fixed folder names."""

import pytest
from pyspark.sql import functions as F

from keystitch import EnrichSpec
from keystitch import job as J
from keystitch.job import enrich_directory
from keystitch.sinks import staged
from keystitch.sources.files import hadoop_glob, hadoop_mkdirs, hadoop_write_text

SPEC = EnrichSpec(order_by=("Taxable_Amount",)).with_targets(["Taxable_Amount"])
HEAD = "Airline PNR,Airline Code,Sector"


@pytest.fixture
def ref(spark):
    return spark.createDataFrame([(i, 2, "A", float(i)) for i in range(0, 4000, 2)],
                                 "PNR_Number bigint, Airline_Code bigint, Travel_Sector string, Taxable_Amount double")


def test_outputs_keep_the_order_of_their_input(spark, scratch, ref):
    """A file of many splits, shuffled by the join: part files by name, rows in them, in order."""
    d, out = f"{scratch}/in", f"{scratch}/out"
    hadoop_mkdirs(spark, d)
    keys = [(7 * i) % 4001 for i in range(4001)]
    hadoop_write_text(spark, f"{d}/long one.csv", f"{HEAD},Note\n" + "".join(f'{k},2,A,"n\n{k}"\n' for k in keys))
    hadoop_write_text(spark, f"{d}/short.csv", f"{HEAD}\n4,2,A\n3,2,A\n")
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(saved, ("4096", "4096", "-1")):
            spark.conf.set(k, v)
        before = J.job_settings
        rep = {r.file.rsplit("/", 1)[-1]: r for r in enrich_directory(spark, d, ref, SPEC, out=out, run_id="1").report.collect()}
        assert before is J.job_settings
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (rep["long one.csv"].rows, rep["long one.csv"].matched) == (4001, sum(k % 2 == 0 and k < 4000 for k in keys))
    got = {tuple(cols): {(r["__ks_output"].split("_")[0], r["__ks_row"]): r["Airline PNR"] for r in rows.collect()} for cols, rows in staged.read_outputs(spark, out, "1")}
    long = got[("Airline PNR", "Airline Code", "Sector", "Note", "Taxable_Amount")]
    assert [int(long[("long one", i)]) for i in range(4001)] == keys
    assert got[("Airline PNR", "Airline Code", "Sector", "Taxable_Amount")] == {("short", 0): "4", ("short", 1): "3"}
    assert hadoop_glob(spark, f"{out}/_staging*") == []


def test_folder_names_do_not_depend_on_columns(spark, scratch, ref):
    d, out = f"{scratch}/in", f"{scratch}/out"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/clash.csv", f"{HEAD},output,sheet,run_id,ks_output\n2,2,A,a,b,c,d\n")
    hadoop_write_text(spark, f"{d}/plain.csv", f"{HEAD}\n4,2,A\n")
    for _ in range(2):   # a replay replaces
        enrich_directory(spark, d, ref, SPEC, out=out, run_id="x 1")
    rows = spark.read.csv(out)   # the whole folder at once
    assert {"run_id", "output", "sheet"} <= set(rows.columns) and rows.count() == 4
    assert {(r.run_id, r.output.split("_")[0]) for r in rows.collect()} == {("x 1", "clash"), ("x 1", "plain")}
    manifest = {r.output.split("_")[0]: r for r in staged.read_manifest(spark, out, "x 1").collect()}
    assert manifest["clash"].columns == [*HEAD.split(","), "output", "sheet", "run_id", "ks_output", "Taxable_Amount"] and manifest["clash"].rows == 1


def test_nothing_is_kept_on_executors(spark, scratch, ref, monkeypatch):
    """No enriched rows are persisted, and counts come with the write."""
    from pyspark.sql import DataFrame
    kept, counted = [], []
    real = type(ref).persist
    monkeypatch.setattr(type(ref), "persist", lambda self, *a: (kept.append(self.columns), real(self, *a))[1])
    monkeypatch.setattr(staged, "counts_by_plan", lambda *a: counted.append(1))
    d = f"{scratch}/in"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/a.csv", f"{HEAD},Note\n2,2,A,x\n3,2,A,y\n")
    hadoop_write_text(spark, f"{d}/bad.csv", f"{HEAD},Note\n2,2,A,x\n3,2,A,y,z\n")
    rep = {r.file.rsplit("/", 1)[-1]: r for r in enrich_directory(spark, d, ref, SPEC, out=f"{scratch}/out", run_id="1").report.collect()}
    assert (rep["a.csv"].rows, rep["a.csv"].matched, rep["bad.csv"].status) == (2, 1, "failed")
    assert not counted and all("Note" not in cols for cols in kept)
    assert {p.rsplit("output=", 1)[1].split("_")[0] for p in hadoop_glob(spark, f"{scratch}/out/*/*")} == {"a"}
    assert isinstance(ref, DataFrame)


def test_counts_that_do_not_add_up_are_not_taken(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("int").alias("__ks_no"), (F.col("id") % 3 == 0).alias("hit"), F.lit(None).cast("string").alias("why"))
    from pyspark.sql import Observation
    seen = Observation("s")
    staged._observed(df, 50, "hit", "why", seen).write.format("noop").mode("overwrite").save()
    rows, hits = staged._exact(spark, seen.get, 50)
    assert rows == [20] * 50 and sum(hits) == 334
    assert staged._exact(spark, {**seen.get, "n": 999}, 50) is None
    targets = [staged.Target(f"f{i}", None, f"o{i}", 0) for i in range(50)]
    assert [s.rows for s in staged.counts_by_plan(df, targets, "hit", "why")] == rows
    assert [s.hits for s in staged.counts_by_plan(df, targets, "hit", "why")] == hits


def test_what_tasks_observe_does_not_grow_with_all_targets(spark):
    """Counts of a task's own targets reach the driver, not one counter or more per target from every task."""
    from pyspark.sql import Observation

    def seen_bytes(n):
        df = spark.range(0, 64, 1, 4).select(F.col("id").cast("int").alias("__ks_no"), (F.col("id") % 2 == 0).alias("hit"), F.lit(None).cast("string").alias("why"))
        seen = Observation(f"few-{n}")
        staged._observed(df, n, "hit", "why", seen).write.format("noop").mode("overwrite").save()
        rows, hits = staged._exact(spark, seen.get, n)
        assert rows[:64] == [1] * 64 and sum(rows) == 64 and hits[:64] == [1, 0] * 32
        return sum(len(str(x)) if not isinstance(x, (bytes, bytearray)) else len(x) for x in (seen.get["rows"], seen.get["hits"]))
    assert seen_bytes(20000) == seen_bytes(100)


@pytest.mark.parametrize("brk, most", [("", 2), ("\n", 3)])
def test_outputs_are_scanned_for_their_borders_and_counts_at_once(spark, scratch, ref, monkeypatch, brk, most):
    """One scan before that of the rows; one more where splits begin in quoted line breaks."""
    from keystitch.sources import records as R
    d, out = f"{scratch}/in", f"{scratch}/out"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/long.csv", f"{HEAD},Note\n" + "".join(f'{k},2,A,"n,{brk}{k}"\n' for k in range(3000)))
    enrich_directory(spark, d, ref, SPEC, out=out, run_id="1")
    scans, real = [], R.scan
    monkeypatch.setattr(R, "scan", lambda *a, **k: (scans.append(1), real(*a, **k))[1])
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in saved:
            spark.conf.set(k, "8192")
        ((_, rows),) = staged.read_outputs(spark, out, "1")
        assert {r["__ks_row"]: (int(r["Airline PNR"]), r["Note"]) for r in rows.collect()} == {i: (i, f"n,{brk}{i}") for i in range(3000)}
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(scans) == most


def test_quoted_records_make_few_runs():
    import pyarrow as pa

    from keystitch.sources.records import Quotes, Stitcher
    st = Stitcher(Quotes(), set(), {})
    st.begin(1, 0, True)
    st.lines(pa.array([b"a,b"] + [x for k in range(500) for x in (b'1,"x', b'%d"' % k)] + [b"2,3"], pa.binary()))
    st.end()
    assert len(st.out) < 5   # not one a record
    rows = [r for r in st.batch().to_pylist() if r["__ks_kind"] == 0]
    assert [r["__ks_raw"] for r in rows] == [b'1,"x\n%d"' % k for k in range(500)] + [b"2,3"]
    assert [r["__ks_at"] for r in rows] == list(range(501))


@pytest.mark.parametrize("reduce_reference, fresh", [(False, False), (True, True)])
def test_files_read_again_join_the_shared_reference_where_it_is_whole(spark, scratch, ref, monkeypatch, reduce_reference, fresh):
    d = f"{scratch}/in"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/a.csv", f"{HEAD},Note\n2,2,A,x\n3,2,A,y\n")
    hadoop_write_text(spark, f"{d}/open.csv", f'{HEAD},Note\n2,2,A,x\n4,2,A,"y\n')
    seen, real = [], J.enrich
    monkeypatch.setattr(J, "enrich", lambda *a, **k: (seen.append(k["shared"] is None), real(*a, **k))[1])
    res = enrich_directory(spark, d, ref, SPEC, out=f"{scratch}/out", run_id="1", reduce_reference=reduce_reference)
    rep = {r.file.rsplit("/", 1)[-1]: r for r in res.report.collect()}
    assert (rep["a.csv"].rows, rep["a.csv"].matched) == (2, 1)
    assert (rep["open.csv"].status, rep["open.csv"].reason) == ("failed", "a quoted cell is not closed")
    assert seen == [False, fresh]


def test_a_reference_that_cannot_be_opened(spark, scratch):
    d = f"{scratch}/in"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/a.csv", f"{HEAD}\n2,2,A\n")
    res = enrich_directory(spark, d, lambda: spark.read.parquet(f"{scratch}/none"), SPEC)
    assert res.summary.first().status == "db_error" and res.report.first().status == "error"
