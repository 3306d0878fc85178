"""The directory job on odd feeds: nothing lost, nothing twice, one bad file
costs no other."""
import pytest
from pyspark.sql import functions as F

from keystitch import EnrichSpec, enrich
from keystitch.job import enrich_directory
from keystitch.session import JOB_CONF, job_settings
from keystitch.sources.csv import csv_layouts, infer_types, read_layout
from keystitch.sources.files import MAX_HEADER_BYTES, hadoop_mkdirs, hadoop_write_text, list_feeds, read_header
from keystitch.sources.reference import key_in_filter
from keystitch.streaming.incremental import read_reports, run_once

SPEC = EnrichSpec(order_by=("Taxable_Amount",)).with_targets(["Taxable_Amount"])


@pytest.fixture
def ref(spark):
    return spark.createDataFrame([(1, 2, "A", 9.5), (3, 4, "B", 8.5)],
                                 "PNR_Number bigint, Airline_Code bigint, Travel_Sector string, Taxable_Amount double")


@pytest.fixture
def folder(spark, scratch):
    def write(files, name="feeds"):
        d = f"{scratch}/{name}"
        hadoop_mkdirs(spark, d)
        for f, text in files.items():
            if isinstance(text, bytes):
                from keystitch.fixtures import _open_output
                with _open_output(f"{d}/{f}") as fh:
                    fh.write(text)
            else:
                hadoop_write_text(spark, f"{d}/{f}", text)
        return d
    return write


def by_name(res):
    return {r["file"].rsplit("/", 1)[-1]: r for r in res.report.collect()}


HEAD = "Airline PNR,Airline Code,Sector"


@pytest.mark.parametrize("split", ["128m", "64"])
def test_rows_do_not_depend_on_the_split_size(spark, folder, split):
    d = folder({"white.csv": f"   \n{HEAD},Note\n1,2,A,x\n \t \n\n3,4,B,y\n", "quoted.csv": f'  \n{HEAD},Note\n1,2,A,"x\ny"\n   \n3,4,B,z\n',
                "short.csv": f"{HEAD},Note\n1,2\n3,4,B,y\n"})
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        (lay,) = csv_layouts(spark, [f.path for f in list_feeds(spark, d, (".csv",))]).layouts
        got = sorted((r.source_file.rsplit("/", 1)[-1], r.row_idx, r["Airline PNR"], r.Note)
                     for r in read_layout(spark, lay, with_row_index=True).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    assert got == [("quoted.csv", 0, "1", "x\ny"), ("quoted.csv", 1, "3", "z"), ("short.csv", 0, "1", None), ("short.csv", 1, "3", "y"),
                   ("white.csv", 0, "1", "x"), ("white.csv", 1, "3", "y")]


def test_headers(spark, folder):
    d = folder({"a.csv": f'{HEAD},"Amount\n(INR)",Qty\n1,2,A,5,6\n', "b.csv": " \n\t\n﻿x\n", "c.csv": "x" * (MAX_HEADER_BYTES + 10),
                "d.csv": "café,b\n1,2\n".encode("latin-1"), "e.csv": " \n\n"})
    assert read_header(spark, f"{d}/a.csv").labels[3:] == ("Amount\n(INR)", "Qty")
    assert read_header(spark, f"{d}/b.csv").lead == 2
    assert "no complete header" in read_header(spark, f"{d}/c.csv").reason
    assert "not UTF-8" in read_header(spark, f"{d}/d.csv").reason
    assert read_header(spark, f"{d}/d.csv", encoding="latin-1").labels == ("café", "b")
    assert read_header(spark, f"{d}/e.csv").labels is None
    assert "unreadable" in read_header(spark, f"{d}/none.csv").reason


def test_one_bad_file_costs_no_other(spark, folder, scratch, ref):
    d = folder({"good.csv": f"{HEAD}\n1,2,A\n", "good2.csv": f"{HEAD}\n3,4,B\n", "ragged.csv": f"{HEAD}\n1,2,A\n3,4,B,EXTRA\n",
                "latin.csv": HEAD.encode() + b"\n1,2,\xe9\n", "case.csv": f"{HEAD},Amount,amount\n1,2,A,5,6\n",
                "clash.csv": f"{HEAD},sheet,Sheet,run_id,output,source_file\n1,2,A,a,b,c,d,e\n", "nokeys.csv": "x\n1\n"})
    paths = [f.path for f in list_feeds(spark, d, (".csv",))] + [f"{d}/gone.csv"]
    out = f"{scratch}/out"
    rep = by_name(enrich_directory(spark, d, ref, SPEC, out=out, run_id="7", paths=paths))
    assert {n: r.status for n, r in rep.items()} == {
        "good.csv": "success", "good2.csv": "success", "ragged.csv": "failed", "latin.csv": "failed", "case.csv": "success",
        "clash.csv": "success", "nokeys.csv": "failed", "gone.csv": "failed"}
    assert "more fields" in rep["ragged.csv"].reason and "UTF-8" in rep["latin.csv"].reason and rep["gone.csv"].reason == "does not exist"
    lines = lambda: sorted(r.value for r in spark.read.text(f"{out}/*/*/*").collect())
    first = lines()
    assert first == sorted([f"{HEAD},Taxable_Amount"] * 2 + ["1,2,A,9.5", "3,4,B,8.5", f"{HEAD},Amount,amount,Taxable_Amount", "1,2,A,5,6,9.5",
                            f"{HEAD},sheet,Sheet,run_id,output,source_file,Taxable_Amount", "1,2,A,a,b,c,d,e,9.5"])
    enrich_directory(spark, d, ref, SPEC, out=out, run_id="7", paths=paths)   # a replayed batch
    assert lines() == first


def test_the_same_through_the_stream(spark, folder, scratch, ref):
    d = folder({"good.csv": f"{HEAD}\n1,2,A\n", "ragged.csv": f"{HEAD}\n1,2,A,B,C\n", "case.csv": f"{HEAD},Amount,amount\n3,4,B,5,6\n"})
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    for _ in range(2):
        run_once(spark, d, ref, SPEC, out, ckpt)
    rep = {r["file"].rsplit("/", 1)[-1]: r["status"] for r in read_reports(spark, out + "_report").collect()}
    assert rep == {"good.csv": "success", "ragged.csv": "failed", "case.csv": "success"}
    assert spark.read.text(f"{out}/*/*/*").where("value like '%9.5' or value like '%8.5'").count() == 2


def test_choice_of_the_first_row_does_not_depend_on_the_folder(spark, folder):
    ref = spark.createDataFrame([(1, 2, "A", 3.0, 7.0, 0), (1, 2, "A", 9.0, 5.0, 0)],
                                "PNR_Number int, Airline_Code int, Travel_Sector string, Taxable_Amount double, NonTaxable_Amount double, o int")
    spec = EnrichSpec(order_by=("o",)).with_targets(["Taxable_Amount", "NonTaxable_Amount"])
    files = {"b.csv": f"{HEAD},Taxable_Amount\n1,2,A,1\n"}
    alone, both = folder(files, "alone"), folder({**files, "a.csv": f"{HEAD}\n1,2,A\n"}, "both")
    got = []
    for d in (alone, both):
        for frame in enrich_directory(spark, d, ref, spec).frames:
            got += [r["NonTaxable_Amount"] for r in frame.collect() if r["__ks_file"].endswith("b.csv")]
    assert got == [7.0, 7.0]


def test_text_keys_are_compared_exactly(spark):
    big = "123456789012345678901234567890"
    ref = spark.sql(f"SELECT 1 AS K1, CAST({big} AS DECIMAL(38,0)) AS K2, 1.5D AS K3, 'hit' AS T, 0 AS O")
    spec = EnrichSpec(key_combinations=[("K1", "K2", "K3")], aliases=[], targets=[("T", "T")], order_by=("O",))
    rows = [("1", big, "1.5", True), (" 01.0 ", big + ".00", "15e-1", True), ("1.00000000001", big, "1.5", False), ("1", big + ".5", "1.5", False),
            ("1e0", big, "1.50", True), ("x", big, "1.5", False), ("", big, "1.5", False), ("1", big[:-1] + "1", "1.5", False)]
    feed = spark.createDataFrame(rows, "K1 string, K2 string, K3 string, want boolean")
    for r in enrich(feed, ref, spec, flag="m").collect():
        assert r.m == r.want, r


def test_in_filter_skips_what_it_cannot_type(spark):
    ref = spark.sql("SELECT DATE'2024-01-01' AS D, 7 AS N, 'x' AS S")
    feed = spark.createDataFrame([("not a date", 7, "x")], "D string, N bigint, S string")
    assert key_in_filter(ref, feed, ["D", "N", "S"]).count() == 1
    assert key_in_filter(ref, feed.withColumn("N", F.lit(8).cast("bigint")), ["D", "N"]).count() == 0


def test_types_are_inferred_strictly(spark):
    rows = [("Y", "F", "12D", "1", "1.5", "True", "t"), ("N", "F", "34F", " -2", "1e3", "false", "t")]
    got = infer_types(spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string"))
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "bigint", "double", "boolean", "string"]


def test_pass_through_is_neither_matched_nor_unmatched(spark, folder, ref):
    d = folder({"full.csv": f"{HEAD},Taxable_Amount\n1,2,A,3\n"})
    r = by_name(enrich_directory(spark, d, ref, SPEC))["full.csv"]
    assert (r.status, r.rows, r.matched, r.unmatched) == ("success", 1, None, None)


def test_settings_of_the_caller_are_kept(spark, folder, ref):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "12345")
    before = {k: spark.conf.get(k, None) for k in [*JOB_CONF, "spark.sql.caseSensitive", "spark.sql.sources.partitionOverwriteMode"]}
    enrich_directory(spark, folder({"a.csv": f"{HEAD}\n1,2,A\n"}), ref, SPEC)
    assert before == {k: spark.conf.get(k, None) for k in before}
    with pytest.raises(ZeroDivisionError), job_settings(spark):
        1 / 0
    assert before == {k: spark.conf.get(k, None) for k in before}
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", JOB_CONF["spark.sql.adaptive.autoBroadcastJoinThreshold"])


def test_output_may_not_lie_in_the_input(spark, folder, ref):
    d = folder({"a.csv": f"{HEAD}\n1,2,A\n"})
    with pytest.raises(ValueError):
        enrich_directory(spark, d, ref, SPEC, out=f"{d}/out")
