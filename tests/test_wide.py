"""Header records read by tasks, and all layouts in one plan."""

import pytest
from pyspark.sql import functions as F

from keystitch.plans import wide
from keystitch.sources.csv import csv_layouts, read_layout
from keystitch.sources.files import MAX_HEADER_BYTES, hadoop_mkdirs, hadoop_write_text, list_feeds, probe_headers
from keystitch.sources.headers import header_table, path_table

FILES = {"a.csv": "Key,,Amount,Amount\n1,x,2.5,3\n2,y,NA,4\n", "b.csv": '"Line\nBreak",amount,Flag\nq,7,true\n"r\ns",8,FALSE\nshort\n', "c one.csv": " \n\nKey,Note\n010,n\n",
         "d.csv": "Key,Late\n3,1e3\n4,inf\n", "empty.csv": "", "big.csv": "x" * (MAX_HEADER_BYTES + 10), "only.csv": "Key,Other\n"}


@pytest.fixture
def feeds(spark, scratch):
    d = f"{scratch}/wide"
    hadoop_mkdirs(spark, d)
    for n, t in FILES.items():
        hadoop_write_text(spark, f"{d}/{n}", t)
    return d


def base(p):
    return p.rsplit("/", 1)[-1]


def test_tasks_read_what_the_driver_reads(spark, feeds):
    paths = [f.path for f in list_feeds(spark, feeds, (".csv",))]
    got = {base(r.path): r for r in header_table(path_table(spark, [*paths, f"{feeds}/gone.csv", feeds])).collect()}
    driver = probe_headers(spark, paths)
    for p in paths:
        assert (got[base(p)].names is None) == (driver[p].labels is None)
    assert got["a.csv"].names == ["Key", "Unnamed: 1", "Amount", "Amount.1"] and got["a.csv"].kept == [0, 2, 3]
    assert got["b.csv"].names[0] == "Line\nBreak" and got["c one.csv"].names == ["Key", "Note"]
    assert {n: got[n].reason for n in ("empty.csv", "gone.csv", base(feeds))} == {"empty.csv": "empty file", "gone.csv": "does not exist", base(feeds): "not a file"}
    assert "no complete header" in got["big.csv"].reason and got["a.csv"].length == len(FILES["a.csv"])


def test_union_equals_the_union_of_the_layouts(spark, feeds):
    heads = header_table(path_table(spark, [f.path for f in list_feeds(spark, feeds, (".csv",))]))
    df = wide.union_csv(spark, heads)
    assert set(df.columns) == {"source_file", "row_idx", "Key", "Amount", "Amount.1", "Line\nBreak", "Flag", "Note", "Late", "Other"}
    got = sorted(tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None and k != "source_file")) + (base(r["source_file"]),) for r in df.collect())
    want = []
    lays = csv_layouts(spark, [r.path for r in heads.where("names is not null").select("path").collect()])
    for lay in lays.layouts:
        for r in read_layout(spark, lay, with_row_index=True).collect():
            cells = {("Amount" if k == "amount" else k): v for k, v in r.asDict().items() if v is not None and k != "source_file"}
            want.append(tuple(sorted(cells.items())) + (base(r["source_file"]),))
    assert got == sorted(want) and len(got) == 8


def test_one_plan_for_any_number_of_layouts(spark, scratch):
    sizes = []
    for n in (3, 40):
        d = f"{scratch}/many{n}"
        hadoop_mkdirs(spark, d)
        for i in range(n):
            hadoop_write_text(spark, f"{d}/f{i}.csv", f"Key,Own {i % 2},Pos\n{i},v{i},p\n" if i % 3 else f"Pos,Key\np,{i}\n")
        df = wide.union_csv(spark, header_table(path_table(spark, [f.path for f in list_feeds(spark, d, (".csv",))])))
        assert {int(r.Key) for r in df.where("Pos = 'p'").collect()} == set(range(n))
        plan = df._jdf.queryExecution().executedPlan().toString()
        sizes.append((plan.count("Scan text"), plan.count("Union"), len(plan.splitlines())))
    assert sizes[0][:2] == sizes[1][:2] == (1, 0) and abs(sizes[0][2] - sizes[1][2]) <= 2


def test_types_per_file_and_of_all(spark, feeds):
    df = wide.union_csv(spark, header_table(path_table(spark, [f.path for f in list_feeds(spark, feeds, (".csv",))])))
    labels = [n for n in df.columns if n not in ("source_file", "row_idx")]
    per = {(base(r.file), r.label): (r.type, r.n) for r in wide.file_types(df, labels).collect()}
    assert per[("a.csv", "Key")] == ("bigint", 2) and per[("a.csv", "Amount")] == ("double", 1) and per[("b.csv", "Flag")] == ("boolean", 2)
    assert per[("d.csv", "Late")] == ("double", 2) and ("only.csv", "Other") not in per
    merged = {r.label: (r.type, r.files) for r in wide.union_types(wide.file_types(df, labels)).collect()}
    assert merged["Key"] == ("bigint", 3) and merged["Amount"] == ("double", 2) and merged["Flag"] == ("boolean", 1)
    rows = wide.typed(df, labels).where(F.col("Key").isNotNull()).collect()
    assert sorted(r.Key for r in rows) == [1, 2, 3, 4, 10] and sorted(r.Amount for r in rows if r.Amount is not None) == [2.5]


@pytest.mark.parametrize("types, want", [([], "string"), (["bigint"], "bigint"), (["bigint", "double"], "double"), (["boolean"], "boolean"),
                                         (["boolean", "bigint"], "string"), (["double", "string"], "string"), (["boolean", "double"], "string")])
def test_least_common_type(spark, types, want):
    df = spark.createDataFrame([(types,)], "t array<string>")
    assert df.select(wide._join_types(F.col("t")).alias("x")).first().x == want
