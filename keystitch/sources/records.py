"""CSV records from splits: where a record begins and ends, in one pass.

A file is read as lines (splittable). Whether a line begins inside a quoted
cell depends on everything before it, so each split is a small automaton: from
either state its lines may begin in (outside or inside a quoted cell) it ends
in one. A split outside the first starts, by *speculation*, outside; its end
states from both starts are kept beside its records as one *edge* row. The
edges of a file, composed from its first split on, tell whether every split
did start outside. That holds unless a quoted line break lies across a split
border, so files are read once. For the others :func:`borders` gives the true
start states; their splits are then read from their own first record, and the
parts of the records across borders are put together.

Rules of a record, as for the job's reader: a quote opens a cell only as its
first character; a doubled quote stays inside; after the closing quote the
rest of the cell is plain; ``\\n``, ``\\r\\n`` and ``\\r`` end a record outside
quoted cells; lines of nothing but spaces and tabs are none; the first record
is the header. A record still open at the end of its file makes the file
unreadable.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import broadcast_threshold

OUT, IN = 0, 1                            # state at the start of a line
RECORD, OPEN, HEAD, TAIL, EDGE = range(5)   # kinds of rows
CLOSES = 4                                # bit of an edge: started inside, the split does get outside

RAW, FID, BLOCK, PLACE, KIND, INFO = "__ks_raw", "__ks_fid", "__ks_blk", "__ks_at", "__ks_kind", "__ks_info"
SCHEMA = T.StructType([T.StructField(RAW, T.BinaryType()), T.StructField(FID, T.LongType()), T.StructField(BLOCK, T.LongType()),
                       T.StructField(PLACE, T.LongType()), T.StructField(KIND, T.IntegerType()), T.StructField(INFO, T.LongType())])


class Quotes:
    """The automaton over one line."""

    def __init__(self, delimiter: str = ",", quote: str = '"'):
        d, q = re.escape(delimiter.encode()), re.escape(quote.encode())
        self.delimiter, self.quote = delimiter.encode(), quote.encode()
        inside = b"[^" + q + b"]*+(?:" + q + q + b"[^" + q + b"]*+)*+"
        self._cell = re.compile(b"(\\A|" + d + b")" + q + inside + q, re.S)
        self._opening = re.compile(b"(?:\\A|" + d + b")" + q, re.S)
        self._closing = re.compile(inside + q, re.S)

    def step(self, state: int, line: bytes) -> int:
        """State after ``line``, which holds no line break."""
        if state == OUT:
            return IN if self.quote in line and self._opening.search(self._cell.sub(rb"\1", line)) else OUT
        m = self._closing.match(line)
        if m is None:
            return IN
        at = line.find(self.delimiter, m.end())
        return OUT if at < 0 else self.step(OUT, line[at + len(self.delimiter):])


@dataclass
class _Split:
    """One split of a file while its lines pass."""
    fid: int
    block: int
    last: bool
    state: int            # at the next line
    header: bool          # the next record is the header
    head: bool            # in a record that began before the split
    other: int | None     # the state, had the split started inside; None once that makes no difference
    closes: bool = False  # so started, a line has ended outside
    pending: list[bytes] = field(default_factory=list)   # of the open record
    n: int = 0            # records that end here, the header too
    at: int = 0           # place of the next record


class Stitcher:
    """Rows of a task's lines. ``starts``: splits known to begin inside a cell
    (fid, block); ``headers``: the split whose first record is the header,
    where that is not the file's first split."""

    def __init__(self, quotes: Quotes, starts: set[tuple[int, int]], headers: dict[int, int], edges_only: bool = False):
        self.quotes, self.starts, self.headers, self.edges_only = quotes, starts, headers, edges_only
        self.split: _Split | None = None
        self.out: list[tuple] = []   # (values, fid, block, first place, kind, info)

    def _emit(self, values, kind: int, at: int = 0, info: int = 0):
        self.out.append((values, self.split.fid, self.split.block, at, kind, info))

    def batch(self):
        """The rows so far as one Arrow batch, None where there are none."""
        import numpy as np
        import pyarrow as pa
        if not self.out:
            return None
        raw = pa.concat_arrays([pa.array(v, pa.binary()) if isinstance(v, list) else v for v, *_ in self.out])
        sizes = [len(v) for v, *_ in self.out]
        fid, block, kind, info = (np.repeat([o[i] for o in self.out], sizes) for i in (1, 2, 4, 5))
        at = np.concatenate([np.arange(o[3], o[3] + n) for o, n in zip(self.out, sizes)])
        self.out = []
        return pa.RecordBatch.from_arrays([raw, pa.array(fid, pa.int64()), pa.array(block, pa.int64()), pa.array(at, pa.int64()),
                                           pa.array(kind, pa.int32()), pa.array(info, pa.int64())], names=SCHEMA.names)

    def begin(self, fid: int, block: int, last: bool) -> None:
        self.end()
        inside = (fid, block) in self.starts
        self.split = _Split(fid, block, last, IN if inside else OUT, self.headers.get(fid, 0) == block, inside,
                            IN if block > 0 and not inside else None)

    def end(self) -> None:
        s = self.split
        if s is None:
            return
        if s.pending:   # a record that is still open
            text = [b"".join(s.pending)]
            if s.head:
                self._emit(text, HEAD)
            else:
                self._emit(text, OPEN if s.last else TAIL, s.at)
        other = s.state if s.other is None else s.other
        self._emit([None], EDGE, s.n, s.state | other << 1 | CLOSES * s.closes)
        self.split = None

    def _records(self, values) -> None:
        """Records in a row; blank lines are gone already."""
        s = self.split
        s.n += len(values)
        if s.header and len(values):
            s.header, values = False, values[1:]
        if len(values):
            if not self.edges_only:
                self._append(values)
            s.at += len(values)

    def _append(self, values) -> None:
        """Records put together one by one go on in the run of those before them."""
        s, last = self.split, self.out[-1] if self.out else None
        if (last is not None and isinstance(values, list) and isinstance(last[0], list) and last[4] == RECORD
                and last[1:3] == (s.fid, s.block) and last[3] + len(last[0]) == s.at):
            last[0].extend(values)
        else:
            self._emit(values, RECORD, s.at)

    def _inside(self, line: bytes, brk: bytes) -> None:
        """A line that begins inside a cell."""
        s = self.split
        s.pending += [line, brk]
        s.state = self.quotes.step(IN, line)
        if s.state == OUT:
            if s.head:
                self._emit([b"".join(s.pending)], HEAD, 0, 1)
                s.head, s.closes = False, True
            else:
                self._records([b"".join(s.pending).rstrip(b"\r\n")])
            s.pending = []

    def lines(self, seg) -> None:
        """A run of lines of the present split (an Arrow binary array)."""
        import numpy as np
        import pyarrow.compute as pc
        s, q = self.split, self.quotes
        offsets = np.frombuffer(seg.buffers()[1], np.int32)[seg.offset:seg.offset + len(seg) + 1]
        data = np.frombuffer(seg.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        quoted = []
        if (data == q.quote[0]).any():
            quoted = np.flatnonzero(pc.match_substring(seg, q.quote.decode()).to_numpy(zero_copy_only=False)).tolist()
        if s.other is not None and quoted:
            self._compare(seg, quoted)
        returns = np.flatnonzero(data == 13) + 1
        if len(returns) and not (np.isin(returns, offsets - offsets[0]) | np.isin(returns, returns - 1)).all():
            return self._one_by_one(seg)
        i, k = 0, 0
        while i < len(seg):
            if s.state == IN:
                self._inside(seg[i].as_py(), b"\n")
                i += 1
                continue
            while k < len(quoted) and (quoted[k] < i or q.step(OUT, seg[quoted[k]].as_py()) == OUT):
                k += 1
            to = quoted[k] if k < len(quoted) else len(seg)
            if to > i:
                part = seg.slice(i, to - i)
                blank = pc.match_substring_regex(part, r"\A[ \t\r]*\z")
                if pc.any(blank).as_py():
                    part = part.filter(pc.invert(blank))
                if len(returns) and len(part):
                    part = pc.replace_substring_regex(part, r"\r+\z", "")
                self._records(part)
            if to < len(seg):
                s.pending, s.state = [seg[to].as_py(), b"\n"], IN
            i = to + 1

    def _one_by_one(self, seg) -> None:
        """Lines with carriage returns inside."""
        s, q = self.split, self.quotes
        for line in seg.to_pylist():
            parts = line.split(b"\r")
            for j, part in enumerate(parts):
                brk = b"\n" if j == len(parts) - 1 else b"\r"
                if s.state == IN:
                    self._inside(part, brk)
                elif q.step(OUT, part) == IN:
                    s.pending, s.state = [part, brk], IN
                elif part.strip(b" \t"):
                    self._records([part])

    def _compare(self, seg, quoted: list[int]) -> None:
        """Go on with the course the split would take, had it started inside,
        until it has been outside and is one with the course from outside.
        Lines without a quote change neither."""
        s, q = self.split, self.quotes
        mine = s.state
        for j in quoted:
            for part in seg[j].as_py().split(b"\r"):
                mine, s.other = q.step(mine, part), q.step(s.other, part)
                s.closes = s.closes or s.other == OUT
            if s.closes and mine == s.other:
                s.other = None
                return


# --- on Spark --------------------------------------------------------------------

def file_table(spark: SparkSession, paths: Sequence[str], file_col: str) -> DataFrame:
    """(file id, path as listed) of the files, one row each."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    plain = re.compile(r"[a-z0-9]+:/[A-Za-z0-9_./=-]*")

    def uri(p):   # the reader's own form of a path: qualified and encoded
        if plain.fullmatch(p) and "//" not in p:
            return p
        jp = path_of(p)
        return re.sub(r"^file:/+", "file:/", jp.getFileSystem(conf).makeQualified(jp).toUri().toString())
    rows = spark.createDataFrame([(p, uri(p)) for p in paths], f"`{file_col}` string, uri string")
    return rows.select(F.xxhash64("uri").alias(FID), file_col)


def scan(spark: SparkSession, paths: Sequence[str], delimiter: str = ",", starts: Iterable[tuple[int, int]] = (),
         headers: dict[int, int] | None = None, edges_only: bool = False) -> DataFrame:
    """Rows of :data:`SCHEMA` of the files: their records (:data:`RECORD`, and
    :data:`OPEN` where the file ends inside one) in place within their split,
    parts of records across borders, one edge per split. ``edges_only`` leaves
    out whole records, which are read all the same."""
    starts, headers, quotes = set(starts), dict(headers or {}), Quotes(delimiter)
    meta = lambda n: F.col(f"_metadata.{n}")
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("value").cast("binary").alias("v"), F.xxhash64(meta("file_path")).alias("f"), meta("file_block_start").alias("b"),
        (meta("file_block_start") + meta("file_block_length") >= meta("file_size")).alias("l"))

    def run(batches):
        import numpy as np
        st = Stitcher(quotes, starts, headers, edges_only)
        for b in batches:
            fid, block, last = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            cuts = np.flatnonzero((np.diff(fid) != 0) | (np.diff(block) != 0)) + 1
            edges = [0, *cuts.tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                s = st.split
                if s is None or (s.fid, s.block) != (fid[lo], block[lo]):
                    st.begin(int(fid[lo]), int(block[lo]), bool(last[lo]))
                st.lines(b.column(0).slice(lo, hi - lo))
            out = st.batch()
            if out is not None:
                yield out
        st.end()
        out = st.batch()
        if out is not None:
            yield out

    return lines.mapInArrow(run, SCHEMA)


def edge_of() -> Column:
    """An edge row as ``struct(fid, block, n, info)``, NULL for other rows."""
    return F.when(F.col(KIND) == EDGE, F.struct(F.col(FID).alias("fid"), F.col(BLOCK).alias("block"), F.col(PLACE).alias("n"), F.col(INFO).alias("info")))


@dataclass(frozen=True)
class Course:
    """What the edges of one file say. ``starts``: splits that begin inside a
    cell; ``parts``: (split, split where the record began) of the records that
    lie across borders, their beginnings too; ``header``: split whose first
    record is the header, None where that one lies across a border; ``open``:
    the file ends inside a cell."""
    starts: tuple[int, ...]
    parts: tuple[tuple[int, int], ...]
    header: int | None
    open: bool

    @property
    def as_speculated(self) -> bool:
        return not self.starts and not self.open and self.header == 0


def course(edges: Iterable[tuple[int, int, int]]) -> Course:
    """Compose a file's edges ``(block, n, info)``."""
    state, starts, parts, began, header, seen = OUT, [], [], None, 0, False
    for block, n, info in sorted(edges):
        if state == IN:
            starts.append(block)
            parts.append((block, began))
            after, more = (info >> 1) & 1, bool(info & CLOSES)
        else:
            after, more = info & 1, True
        if not seen and more and (state == IN or n > 0 or after == IN):
            # where the first record ends
            seen, header = True, (block if state == OUT and n > 0 else None)
        if after == IN and more:
            began = block
            parts.append((block, block))
        state = after
    return Course(tuple(starts), tuple(parts), header, state == IN)


def courses(rows) -> dict[int, Course]:
    """Per file id the course of its edge rows."""
    per: dict[int, list] = {}
    for r in rows:
        per.setdefault(r["fid"], []).append((r["block"], r["n"], r["info"]))
    return {fid: course(edges) for fid, edges in per.items()}


@dataclass(frozen=True)
class Borders:
    """What reading files whose records lie across borders needs."""
    starts: tuple[tuple[int, int], ...] = ()
    headers: tuple[tuple[int, int], ...] = ()
    parts: tuple[tuple[int, int, int, bool], ...] = ()     # file id, split, where the record began, is it the header

    @classmethod
    def of(cls, found: dict[int, Course]) -> "Borders":
        starts, headers, parts = [], [], []
        for fid, c in found.items():
            starts += [(fid, b) for b in c.starts]
            if c.header != 0:
                headers.append((fid, -1 if c.header is None else c.header))
            first = min((b for _, b in c.parts), default=None)
            parts += [(fid, b, began, c.header is None and began == first) for b, began in c.parts]
        return cls(tuple(starts), tuple(headers), tuple(parts))


def borders(spark: SparkSession, paths: Sequence[str], delimiter: str = ",") -> Borders:
    """One scan of the files for their edges (one row a split reaches the driver)."""
    if not paths:
        return Borders()
    return Borders.of(courses(_edges(spark, paths, delimiter)))


def _edges(spark: SparkSession, paths: Sequence[str], delimiter: str) -> list:
    return scan(spark, paths, delimiter, edges_only=True).where(F.col(KIND) == EDGE).select(edge_of().alias("e")).select("e.*").collect()


def survey(spark: SparkSession, paths: Sequence[str], delimiter: str = ",") -> tuple[Borders, list[tuple[int, int, int]]]:
    """:func:`borders` and :func:`row_counts` of all files from one scan; a
    second one only where a split does not begin a record (of the same files,
    as the splits are those of a scan)."""
    if not paths:
        return Borders(), []
    edges = _edges(spark, paths, delimiter)
    found = courses(edges)
    known = Borders.of(found)
    if not all(f.as_speculated for f in found.values()):
        return known, row_counts(spark, paths, delimiter, known)
    return known, [(r["fid"], r["block"], max(0, r["n"] - (r["block"] == 0))) for r in edges]   # the header is in the first


def row_counts(spark: SparkSession, paths: Sequence[str], delimiter: str, known: Borders) -> list[tuple[int, int, int]]:
    """(file id, split, rows that begin in it): one row a split."""
    rows = scan(spark, paths, delimiter, known.starts, dict(known.headers)).where(F.col(KIND).isin(RECORD, OPEN, TAIL))
    heads = {(fid, b) for fid, b, began, header in known.parts if header and b == began}
    return [(r[FID], r[BLOCK], r["n"] - ((r[FID], r[BLOCK]) in heads)) for r in rows.groupBy(FID, BLOCK).agg(F.count("*").alias("n")).collect()]


def records(spark: SparkSession, paths: Sequence[str], delimiter: str = ",", known: Borders = Borders()) -> DataFrame:
    """``scan`` with the records across borders as :data:`RECORD` rows (or
    :data:`OPEN`), in place behind those of the split they begin in."""
    rows = scan(spark, paths, delimiter, known.starts, dict(known.headers))
    if not known.parts:
        return rows
    table = spark.createDataFrame(list(known.parts), f"{FID} long, {BLOCK} long, began long, header boolean")
    found = rows.where(F.col(KIND).isin(HEAD, TAIL)).join(table.alias("t"), [FID, BLOCK])
    # a split may end one record and begin another: its head goes with the one that began before it
    found = found.where((F.col(KIND) == TAIL) == (F.col("began") == F.col(BLOCK)))
    whole = found.groupBy(FID, "began", "header").agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, RAW))).alias("x"), F.max(PLACE).alias(PLACE), F.max(INFO).alias("done"))
    text = F.array_join(F.transform("x", lambda p: F.hex(p[RAW])), "")   # a record's parts, as long as the record
    text = F.unhex(F.regexp_replace(text, "(0D|0A)+$", ""))
    whole = whole.where("not header").select(text.alias(RAW), FID, F.col("began").alias(BLOCK), PLACE,
                                             F.when(F.col("done") == 1, RECORD).otherwise(OPEN).cast("int").alias(KIND), F.lit(0).cast("long").alias(INFO))
    return rows.where(~F.col(KIND).isin(HEAD, TAIL)).unionByName(whole)


def numbered(spark: SparkSession, rows: DataFrame, splits: Sequence[str], delimiter: str, known: Borders,
             counted: list[tuple[int, int, int]] | None = None) -> tuple[DataFrame, Column]:
    """(rows, 0-based row number within each file), without a global sort (G1,
    H4): a row's place in its split, plus the rows of the file's earlier
    splits. Only files that may be split (``splits``) have more than one, and
    only these are scanned for the counts of their splits, unless those are known
    (``counted``)."""
    if not splits or counted == []:
        return rows, F.col(PLACE)
    if counted is None:
        counted = row_counts(spark, splits, delimiter, known)
    w = Window.partitionBy(FID).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = spark.createDataFrame(counted, f"{FID} long, {BLOCK} long, __ks_n long").select(
        FID, BLOCK, F.coalesce(F.sum("__ks_n").over(w), F.lit(0)).alias("__ks_before"))
    if len(counted) * 64 <= broadcast_threshold(spark):
        before = F.broadcast(before)
    return rows.join(before, [FID, BLOCK], "left"), F.coalesce(F.col("__ks_before"), F.lit(0)) + F.col(PLACE)
