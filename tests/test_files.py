"""CSV and workbook readers on hand-made files in a scratch folder."""
from keystitch.job import enrich_directory
from keystitch.sources.csv import csv_layouts, read_layout
from keystitch.sources.files import hadoop_mkdirs, hadoop_write_text, list_feeds
from keystitch.sources.workbook import _Book, read_workbooks, xlsx_bytes
from keystitch.spec import EnrichSpec


def test_csv_quirks(spark, scratch):
    d = f"{scratch}/feeds"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/a.csv", '\n\nAirline PNR,,Sector,Note,Note\n1,x,A,"q,1",n1\n2,y,NA,"multi\nline",n2\n')
    hadoop_write_text(spark, f"{d}/b.CSV", "Airline PNR,Sector\n")
    hadoop_write_text(spark, f"{d}/c.csv", "")
    files = list_feeds(spark, d, (".csv",))
    assert [f.path.rsplit("/", 1)[-1] for f in files] == ["a.csv", "b.CSV", "c.csv"]
    lays = csv_layouts(spark, [f.path for f in files if f.length])
    a = next(lay for lay in lays.layouts if lay.paths[0].endswith("a.csv"))
    assert a.columns == ["Airline PNR", "Sector", "Note", "Note.1"]
    rows = read_layout(spark, a, with_row_index=True).orderBy("row_idx").collect()
    assert [(r["Airline PNR"], r["Sector"], r["Note"], r["row_idx"]) for r in rows] == [
        ("1", "A", "q,1", 0), ("2", None, "multi\nline", 1)]


def test_directory_job_statuses(spark, scratch):
    d = f"{scratch}/job"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/ok.csv", "Airline PNR,Airline Code,Sector\n1,2,A\n3,4,B\n")
    hadoop_write_text(spark, f"{d}/nokeys.csv", "x,y\n1,2\n")
    hadoop_write_text(spark, f"{d}/empty.csv", "")
    ref = spark.createDataFrame([(1, 2, "A", 9.5)], "PNR_Number bigint, Airline_Code bigint, "
                                                    "Travel_Sector string, Taxable_Amount double")
    res = enrich_directory(spark, d, ref, EnrichSpec().with_targets(["Taxable_Amount"]), out=f"{scratch}/out")
    rep = {r["file"].rsplit("/", 1)[-1]: r for r in res.report.collect()}
    assert rep["ok.csv"]["status"] == "success" and rep["ok.csv"]["rows"] == 2 and rep["ok.csv"]["matched"] == 1
    assert rep["nokeys.csv"]["status"] == "failed" and rep["nokeys.csv"]["error"] == "Processing failed"
    assert rep["empty.csv"]["status"] == "failed"
    s = res.summary.first()
    assert (s["processed"], s["errors"], s["color"]) == (1, 2, "orange")


def test_xlsx_roundtrip_and_header_rule(spark, scratch):
    data = xlsx_bytes([("S1", [["title"], ["a", "b", "c"], [1, "x", 2.5], [None, None, None], [2, "y", True]]),
                       ("S2", [])])
    book = _Book(data)
    rows = list(book.rows(book.sheets[0][1]))
    assert rows[0] == (["title"], ["string"])
    assert rows[2] == (["1", "x", "2.5"], ["number", "string", "number"])
    assert rows[3] == ([], [])   # a row without filled cells is a row
    assert rows[4] == (["2", "y", "True"], ["number", "string", "bool"])
    assert list(book.rows(book.sheets[1][1])) == []
    from keystitch.fixtures import _open_output
    d = f"{scratch}/books"
    hadoop_mkdirs(spark, d)
    with _open_output(f"{d}/w.xlsx") as fh:
        fh.write(data)
    wb = read_workbooks(spark, [f"{d}/w.xlsx"])
    (lay,) = wb.layouts
    assert lay.columns == ["a", "b", "c"] and lay.sheets[0][2] == 1
    assert lay.frame.count() == 3


def test_run_statuses(spark, scratch):
    d = f"{scratch}/runs"
    hadoop_mkdirs(spark, d)
    spec = EnrichSpec().with_targets(["Taxable_Amount"])
    ref = spark.createDataFrame([(1, 2, "A", 9.5)], "PNR_Number bigint, Airline_Code bigint, "
                                                    "Travel_Sector string, Taxable_Amount double")
    empty = enrich_directory(spark, d, ref, spec).summary.first()
    assert (empty["status"], empty["color"]) == ("no_files", "red")
    hadoop_write_text(spark, f"{d}/ok.csv", "Airline PNR,Airline Code,Sector\n1,2,A\n")
    hadoop_write_text(spark, f"{d}/ok2.csv", "Airline PNR,Airline Code,Sector\n1,2,A\n")

    class Broken:
        @property
        def schema(self):
            raise RuntimeError("cannot connect")
    s = enrich_directory(spark, d, Broken(), spec).summary.first()
    assert (s["status"], s["processed"], s["errors"], s["color"]) == ("db_error", 0, 2, "red")


def test_critical_error_status(spark, scratch):
    d = f"{scratch}/crit"
    hadoop_mkdirs(spark, d)
    hadoop_write_text(spark, f"{d}/ok.csv", "Airline PNR,Airline Code,Sector\n1,2,A\n")
    spec = EnrichSpec().with_targets(["Taxable_Amount"])

    class Odd:   # opens fine, then breaks while the run is planned
        schema = spark.createDataFrame([], "PNR_Number bigint").schema

        @property
        def columns(self):
            raise RuntimeError("lost connection")
    s = enrich_directory(spark, d, Odd(), spec, on_error="report").summary.first()
    assert (s["status"], s["color"]) == ("critical_error", "red")


def test_rows_and_their_order_across_splits(spark, scratch):
    d = f"{scratch}/big"
    hadoop_mkdirs(spark, d)
    rows = "".join(f"{i},{i % 7},A{i}\n" for i in range(400))
    hadoop_write_text(spark, f"{d}/clean.csv", "Airline PNR,Airline Code,Sector\n" + rows)
    hadoop_write_text(spark, f"{d}/quoted.csv", 'Airline PNR,Airline Code,Sector\n1,2,"two\nlines"\n' + rows)
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        (lay,) = csv_layouts(spark, [f.path for f in list_feeds(spark, d, (".csv",))]).layouts
        got = read_layout(spark, lay, with_row_index=True).collect()
        clean = sorted((r["row_idx"], r["Airline PNR"]) for r in got if r["source_file"].endswith("clean.csv"))
        assert clean == [(i, str(i)) for i in range(400)]
        quoted = sorted((r["row_idx"], r["Sector"]) for r in got if r["source_file"].endswith("quoted.csv"))
        assert quoted == [(0, "two\nlines")] + [(i + 1, f"A{i}") for i in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)

def test_concurrent_layout_writes_are_complete(spark, scratch):
    from pyspark.sql import functions as F
    d = f"{scratch}/multi"
    hadoop_mkdirs(spark, d)
    for i in range(6):   # three layouts, two files each
        head = ["Airline PNR,Airline Code,Sector", "Sector,Airline Code,Airline PNR,x", "pnr number,airlinecode,sector"][i % 3]
        body = "".join((f"{k},{k % 5},A\n" if i % 3 != 1 else f"A,{k % 5},{k},z\n") for k in range(50 + i))
        hadoop_write_text(spark, f"{d}/f{i}.csv", head + "\n" + body)
    ref = spark.createDataFrame([(k, k % 5, "A", float(k)) for k in range(0, 60, 2)],
                                "PNR_Number bigint, Airline_Code bigint, Travel_Sector string, Taxable_Amount double")
    out = f"{scratch}/multi_out"
    res = enrich_directory(spark, d, ref, EnrichSpec().with_targets(["Taxable_Amount"]), out=out, run_id="r",
                           parallel_layouts=3)
    rep = {r["output"]: r for r in res.report.collect()}
    assert len(rep) == 6 and all(r["status"] == "success" for r in rep.values())
    got = {}
    for o in rep:   # each output has its own layout: read it on its own
        df = spark.read.option("header", True).csv(f"{out}/run_id=r/output={o}")
        got[o] = tuple(df.agg(F.count(F.lit(1)), F.count("Taxable_Amount")).first())
    assert got == {o: (r["rows"], r["matched"]) for o, r in rep.items()}


def test_incremental_job_takes_workbooks_once(spark, scratch):
    from keystitch.fixtures import _open_output
    from keystitch.streaming.incremental import read_reports, run_once
    inbox = f"{scratch}/wb_inbox"
    hadoop_mkdirs(spark, inbox)
    data = xlsx_bytes([("S1", [["Airline PNR", "Airline Code", "Sector"], [1, 2, "A"], [3, 4, "B"]]),
                       ("S2", [["x", "y", "z"], [1, 2, 3]])])
    with _open_output(f"{inbox}/book.xlsx") as fh:
        fh.write(data)
    ref = spark.createDataFrame([(1, 2, "A", 9.5)], "PNR_Number bigint, Airline_Code bigint, "
                                                    "Travel_Sector string, Taxable_Amount double")
    spec = EnrichSpec().with_targets(["Taxable_Amount"])
    out, ckpt = f"{scratch}/wb_out", f"{scratch}/wb_ckpt"
    run_once(spark, inbox, ref, spec, out, ckpt, name="ks_wb_1")
    run_once(spark, inbox, ref, spec, out, ckpt, name="ks_wb_2")      # nothing new: no second batch
    rep = read_reports(spark, out + "_report").collect()
    assert len(rep) == 1
    r = rep[0]
    assert (r["status"], r["rows"], r["matched"], r["sheets"], r["sheets_info"]) == ("success", 2, 1, 1, {"S1": 2})


def test_spec_from_json_on_any_filesystem(spark, scratch):
    import json
    cfg = {"supported_extensions": [".xlsx", ".csv"],
           "column_mapping": {"Airline PNR": "PNR_Number", "Airline Code": "Airline_Code", "Sector": "Travel_Sector"},
           "possible_reference_combinations": [["PNR_Number", "Airline_Code", "Travel_Sector"]],
           "targets": ["Taxable_Amount", {"column": "Booking_Date", "display": "Booking Date"}],
           "order_by": ["-Booking_Date"]}
    path = f"{scratch}/job_spec.json"
    hadoop_write_text(spark, path, json.dumps(cfg))
    spec = EnrichSpec.from_json(path, spark=spark)
    assert spec.aliases[0] == ("Airline PNR", "PNR_Number") and spec.extensions == (".xlsx", ".csv")
    assert spec.targets == (("Taxable_Amount", "Taxable_Amount"), ("Booking_Date", "Booking Date"))
    assert spec.order_by == ("-Booking_Date",)


def test_read_reference_prunes_and_renames(spark):
    from pyspark.sql import functions as F

    from keystitch.sources.reference import read_reference
    df = read_reference(spark, "/root/testdata/sf0.001/orders.parquet",
                        rename={"o_orderkey": "PNR_Number", "o_totalprice": "Taxable_Amount"},
                        where=F.col("o_orderstatus") == "F", columns=["PNR_Number", "Taxable_Amount"])
    assert df.columns == ["PNR_Number", "Taxable_Amount"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_custkey" not in plan


def test_shared_strings_rich_text_and_phonetics():
    import io
    import zipfile

    from keystitch.sources.workbook import _Book
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{rel}"><sheets>'
                                      '<sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>plain</t></si>'
                                           '<si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>PHON</t></rPh></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1">'
                                               '<c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c>'
                                               '</row></sheetData></worksheet>')
    book = _Book(buf.getvalue())
    assert list(book.rows(book.sheets[0][1])) == [(["plain", None, "rich"], ["string", None, "string"])]
