"""Record boundaries: any text, any split, against one pass over the whole file."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keystitch.sources import records as R
from keystitch.sources.csv import csv_layouts, read_layout
from keystitch.sources.files import hadoop_mkdirs, hadoop_write_text, list_feeds


def whole(text: str) -> tuple[list[str], bool]:
    """(records with the header, open at the end) by one walk over the characters."""
    out, rec, state, start = [], "", "start", True
    i = 0
    while i < len(text):
        c = text[i]
        if state == "in":
            rec += c
            if c == '"':
                if text[i + 1:i + 2] == '"':
                    rec += '"'
                    i += 1
                else:
                    state = "plain"
        elif c in "\r\n":
            if rec.strip(" \t"):
                out.append(rec)
            rec, state = "", "start"
        else:
            state = "in" if c == '"' and state == "start" else "start" if c == "," else "plain"
            rec += c
        i += 1
    if rec.strip(" \t"):
        out.append(rec)
    return out, state == "in"


@pytest.fixture
def splits(spark):
    """Scans in splits of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}

    def set_(n):
        for k in keys:
            spark.conf.set(k, str(n))
    yield set_
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


PIECES = ["a", "b,", ",", '"', '""', "\n", "\r\n", '"x\ny"', ' "p', '5" pipe', "é", "\n\n", " \t\n", '"q""r",', "\r", "z\n", "k,l\n"]


ODD = ['"h\n1",h2\n1,2\n', "\n \n\t\n\r\nh1,h2\n1,2\n", 'h\n"' + "x\n" * 50 + '"\nlast', 'h\n"open', "h", "\n", 'h\n1,"a\n\n\nb",2\n3,4', '"a","\n"\n' * 20,
       'h1,h2\n"x\ny"\r5" pipe,"\n5" pipe"k,l\n', 'a,b\r1,2\r\r3,"4\r5"\r']


def random_text(r):
    return "h1,h2\n" + "".join(r.choice(PIECES) for _ in range(r.randint(0, 40)))


def in_splits(text: str, size: int) -> dict[int, list[bytes]]:
    """A file's lines by the split they begin in."""
    out, at = {}, 0
    lines = text.encode().split(b"\n")
    for i, line in enumerate(lines):
        if i < len(lines) - 1 or line:
            out.setdefault(at // size * size, []).append(line)
        at += len(line) + 1
    return out


def stitched(parts: dict[int, list[bytes]], known=R.Borders(), batch=2):
    st = R.Stitcher(R.Quotes(), set(known.starts), dict(known.headers))
    for block, lines in parts.items():
        st.begin(1, block, block == max(parts))
        for i in range(0, len(lines), batch):
            st.lines(pa.array([b"-", *lines[i:i + batch]], pa.binary()).slice(1))
        st.end()
    b = st.batch()
    return b.to_pylist() if b is not None else []


@pytest.mark.parametrize("size", [1, 5, 20, 100, 10_000])
def test_records_of_any_text_in_any_splits(size):
    r = random.Random(size)
    for text in ODD + [random_text(r) for _ in range(400)]:
        parts = in_splits(text, size)
        edges = [(x[R.BLOCK], x[R.PLACE], x[R.INFO]) for x in stitched(parts) if x[R.KIND] == R.EDGE]
        known = R.Borders.of({1: R.course(edges)})
        rows = stitched(parts, known)
        found = [(x[R.BLOCK], x[R.PLACE], x[R.RAW], x[R.KIND]) for x in rows if x[R.KIND] in (R.RECORD, R.OPEN)]
        for began in {p[2] for p in known.parts}:
            mine = [(p[1], p[3]) for p in known.parts if p[2] == began]
            if mine[0][1]:
                continue   # the header
            pieces = [x for b, _ in mine for x in rows if x[R.BLOCK] == b and x[R.KIND] == (R.TAIL if b == began else R.HEAD)]
            if not pieces:
                continue   # it begins in the last split, which tells itself
            raw = b"".join(x[R.RAW] for x in pieces).rstrip(b"\r\n")
            found.append((began, max(x[R.PLACE] for x in pieces), raw, R.RECORD if max(x[R.INFO] for x in pieces) else R.OPEN))
        want, is_open = whole(text)
        got = [(raw.decode(), kind) for _, _, raw, kind in sorted(found)]
        kinds = [R.RECORD] * (len(want) - 1)
        if is_open and len(want) > 1:
            assert got[-1][1] == R.OPEN, (text, got)
            assert got[:-1] == [(w, R.RECORD) for w in want[1:-1]], (text, got)
        elif not is_open:
            assert got == list(zip(want[1:], kinds)), (text, got)
        if not known.parts and not known.headers:   # speculation held: one pass gave the same rows
            assert stitched(parts) == rows


@pytest.mark.parametrize("size", [3, 64, 1 << 20])
def test_records_on_spark(spark, scratch, splits, size):
    r = random.Random(size)
    texts = ODD + [random_text(r) for _ in range(8)]
    d = f"{scratch}/texts"
    hadoop_mkdirs(spark, d)
    for i, t in enumerate(texts):
        hadoop_write_text(spark, f"{d}/f{i}.csv", t)
    splits(size)
    paths = [f.path for f in list_feeds(spark, d, (".csv",))]
    known = R.borders(spark, paths)
    rows = R.records(spark, paths, ",", known).where(F.col(R.KIND).isin(R.RECORD, R.OPEN)).join(R.file_table(spark, paths, "p"), R.FID)
    got: dict = {}
    for x in rows.orderBy("p", R.BLOCK, R.PLACE).collect():
        got.setdefault(x["p"], []).append(bytes(x[R.RAW]).decode())
    counts: dict = {}
    for fid, _, n in R.row_counts(spark, paths, ",", known):
        counts[fid] = counts.get(fid, 0) + n
    ids = {x["p"]: x[R.FID] for x in R.file_table(spark, paths, "p").collect()}
    for p in paths:
        want, is_open = whole(texts[int(p.rsplit("/f", 1)[1][:-4])])
        assert counts.get(ids[p], 0) == len(got.get(p, []))
        if not is_open:
            assert got.get(p, []) == want[1:], (want, size)


def test_speculation_tells_when_it_was_wrong(spark, scratch, splits):
    from pyspark.sql import Observation
    from keystitch.sources.csv import misread
    d = f"{scratch}/spec"
    hadoop_mkdirs(spark, d)
    long = "".join(f'{i},"v{i}",w\n' for i in range(50))
    hadoop_write_text(spark, f"{d}/plain.csv", "a,b,c\n" + long)
    hadoop_write_text(spark, f"{d}/broken cell.csv", "a,b,c\n" + long + '1,"' + "line\n" * 60 + '",x\n' + long)
    hadoop_write_text(spark, f"{d}/open.csv", "a,b,c\n" + long + '1,"never')
    splits(64)
    (lay,) = csv_layouts(spark, [f.path for f in list_feeds(spark, d, (".csv",))]).layouts
    seen = Observation("spec")
    read_layout(spark, lay, speculate=seen).write.format("noop").mode("overwrite").save()
    assert [p.rsplit("/", 1)[-1] for p in misread(spark, lay, seen)] == ["broken cell.csv", "open.csv"]
    rows = read_layout(spark, lay, with_row_index=True, problem_col="why").collect()
    by = {}
    for r in rows:
        by.setdefault(r.source_file.rsplit("/", 1)[-1], []).append(r)
    assert {n: len(v) for n, v in by.items()} == {"plain.csv": 50, "broken cell.csv": 101, "open.csv": 51}
    assert all(sorted(r.row_idx for r in v) == list(range(len(v))) for v in by.values())
    assert [r.b for r in by["broken cell.csv"] if r.row_idx == 50] == ["line\n" * 60]
    assert {(n, r.why) for n, v in by.items() for r in v if r.why} == {("open.csv", "a quoted cell is not closed")}


def test_a_line_break_in_quotes_costs_no_tasks(spark, scratch, splits):
    d = f"{scratch}/tasks"
    hadoop_mkdirs(spark, d)
    lines = "".join(f"{i},x,y\n" for i in range(3000))
    hadoop_write_text(spark, f"{d}/plain.csv", "a,b,c\n" + lines)
    hadoop_write_text(spark, f"{d}/quoted.csv", 'a,b,c\n1,"p\nq",r\n' + lines)
    splits(4096)
    tasks = {}
    for name in ("plain", "quoted"):
        (lay,) = csv_layouts(spark, [f"file:{d}/{name}.csv" if d.startswith("/") else f"{d}/{name}.csv"]).layouts
        df = read_layout(spark, lay)
        tasks[name] = df.rdd.getNumPartitions()
        assert df.count() == 3000 + (name == "quoted")
    assert tasks["quoted"] >= tasks["plain"] > 4


def test_stray_and_open_quotes_fail_their_file(spark, scratch):
    from keystitch import EnrichSpec
    from keystitch.job import enrich_directory
    d = f"{scratch}/stray"
    hadoop_mkdirs(spark, d)
    head = "Airline PNR,Airline Code,Sector,Note\n"
    hadoop_write_text(spark, f"{d}/five.csv", head + '1,2,5" pipe,4,6" x\n1,2,A,ok\n')
    hadoop_write_text(spark, f"{d}/open.csv", head + '1,2,B,"open\n1,2,A,x\n1,2,A,y\n')
    hadoop_write_text(spark, f"{d}/four.csv", head + '1,2,A,6" x\n1,2,A,"6"" x"\n')
    ref = spark.createDataFrame([(1, 2, "A", 9.5)], "PNR_Number bigint, Airline_Code bigint, Travel_Sector string, Taxable_Amount double")
    rep = {r["file"].rsplit("/", 1)[-1]: r for r in enrich_directory(spark, d, ref, EnrichSpec().with_targets(["Taxable_Amount"]), out=f"{scratch}/o").report.collect()}
    assert {n: (r.status, r.rows) for n, r in rep.items()} == {"five.csv": ("failed", None), "open.csv": ("failed", None), "four.csv": ("success", 2)}
    assert "more fields" in rep["five.csv"].reason and "not closed" in rep["open.csv"].reason
