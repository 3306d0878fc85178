"""Multi-layout CSV feeds.

Files in one directory may carry different headers. Spark never names the
columns from the header (H1: its duplicate-name rules differ from the job's);
instead each file's first record is probed as metadata, files are grouped by
header signature, and each group is read with one positional all-string
schema. Per group that is a single splittable scan; the groups' enriched
frames are unioned by name.

Records come from :mod:`.records`: quoted line breaks are honoured in every
split, and what a file's rows are depends on its bytes only, never on its size
or splits. Lines of spaces and tabs are no rows, a row with fewer fields than
the header is filled with NULL; a row with more fields, bytes that are not
text in the encoding, or a quoted cell that the file's end leaves open are
marked: the job fails that file.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import NA_TOKENS, c, na_to_null
from ..operators.enrich import broadcast_threshold
from ..session import observed
from . import records as R
from .files import list_feeds, parse_header, probe_headers  # noqa: F401

SOURCE_FILE = "source_file"
ROW_IDX = "row_idx"


def header_names(raw: Sequence[str]) -> list[str]:
    """Column labels the job sees for a raw header: blank -> ``Unnamed: <pos>``;
    a repeated label gets the first suffix ``.1``, ``.2`` ... that gives a label
    neither in the header nor taken already."""
    names = [h if h != "" else f"Unnamed: {i}" for i, h in enumerate(raw)]
    taken: set[str] = set()
    suffix: Counter[str] = Counter()
    out = []
    for name in names:
        label = name
        while label in taken or (label != name and label in names):
            suffix[name] += 1
            label = f"{name}.{suffix[name]}"
        taken.add(label)
        out.append(label)
    return out


def kept_positions(names: Sequence[str]) -> list[int]:
    """Positions whose label does not start with ``Unnamed:`` (A5)."""
    return [i for i, n in enumerate(names) if not str(n).startswith("Unnamed:")]


@dataclass
class CsvLayout:
    names: tuple[str, ...]          # all labels, header order
    kept: tuple[int, ...]           # positions kept after A5
    paths: list[str] = field(default_factory=list)
    sizes: dict[str, int] = field(default_factory=dict)   # from the listing, when known

    @property
    def columns(self) -> list[str]:
        return [self.names[i] for i in self.kept]

    @property
    def dropped(self) -> list[str]:
        return [n for i, n in enumerate(self.names) if i not in self.kept]


@dataclass
class CsvFeeds:
    layouts: list[CsvLayout]
    failures: list[tuple[str, str]]   # (path, reason)


def csv_layouts(spark: SparkSession, paths: Sequence[str], delimiter: str = ",",
                sizes: dict[str, int] | None = None, encoding: str = "UTF-8", probe_files: int = 64) -> CsvFeeds:
    """Group CSV files by header signature (metadata only). ``sizes`` (file
    lengths from the listing) saves a metadata call per file later on. Up to
    ``probe_files`` files the driver reads the first records itself; of more,
    tasks do (:func:`headers.header_table`)."""
    sizes = sizes or {}
    found: dict[str, tuple] = {}
    if len(paths) > probe_files:
        from .headers import header_table, path_table
        for r in header_table(path_table(spark, paths), encoding=encoding, delimiter=delimiter).collect():   # the listing, with labels
            found[r["path"]] = (None if r["names"] is None else tuple(r["names"]), r["reason"])
    else:
        for p, h in probe_headers(spark, list(paths), encoding=encoding, delimiter=delimiter).items():
            found[p] = (None if h.labels is None else tuple(header_names(h.labels)), h.reason)
    groups: dict[tuple[str, ...], CsvLayout] = {}
    failures = []
    for p in paths:
        names, reason = found[p]
        if names is None:
            failures.append((p, reason))
            continue
        lay = groups.get(names)
        if lay is None:
            lay = groups[names] = CsvLayout(names, tuple(kept_positions(names)))
        lay.paths.append(p)
        if p in sizes:
            lay.sizes[p] = sizes[p]
    return CsvFeeds(list(groups.values()), failures)


def _conf_bytes(spark: SparkSession, key: str, default: int) -> int:
    try:
        return int(str(spark.conf.get(key, str(default))).rstrip("b"))
    except ValueError:   # with a unit: take the least there is
        return 0


def may_split(spark: SparkSession, sizes: dict[str, int]) -> list[str]:
    """Files that a scan may deal to several tasks; smaller ones never are."""
    whole = min(_conf_bytes(spark, "spark.sql.files.maxPartitionBytes", 128 << 20),
                _conf_bytes(spark, "spark.sql.files.openCostInBytes", 4 << 20))
    return [p for p, n in sizes.items() if n > whole]


def _file_sizes(spark: SparkSession, paths: Sequence[str], known: dict[str, int] | None = None) -> dict[str, int]:
    from .files import _fs
    out = {p: known[p] for p in paths if known and p in known}
    for p in paths:
        if p not in out:
            fs, jp = _fs(spark, p)
            out[p] = int(fs.getFileStatus(jp).getLen())
    return out


_BAD, _TEXT, _CELLS = "__ks_bad", "__ks_text", "__ks_cells"


def _kind(encoding: str) -> str:
    """``utf8``; ``wide``: a line feed is not one byte of its own, so files are
    not split; ``bytes``: any other."""
    name = encoding.lower().replace("-", "").replace("_", "")
    return "utf8" if name in ("utf8", "ascii", "usascii") else "wide" if name.startswith(("utf16", "utf32")) else "bytes"


def _fields(raw: Column, delimiter: str) -> Column:
    """Number of fields of a raw record: delimiters outside quoted cells, and
    one. A quote opens a cell only as its first character."""
    bare = F.regexp_replace(raw, rf'(^|\Q{delimiter}\E)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return (F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))) / len(delimiter) + 1


def _wide_rows(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str) -> DataFrame:
    """Rows of :data:`records.SCHEMA`, as UTF-8, of files whose line feeds take
    several bytes: one task reads a file whole."""
    quotes = R.Quotes(delimiter)
    files = spark.read.format("binaryFile").load(list(paths)).select(F.xxhash64("_metadata.file_path").alias("f"), "content")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for fid, content in zip(b.column(0).to_pylist(), b.column(1)):
                lines = content.as_py().decode(encoding, "replace").removeprefix("﻿").encode().split(b"\n")
                st = R.Stitcher(quotes, set(), {})
                st.begin(fid, 0, True)
                st.lines(pa.array(lines, pa.binary()))   # text behind the last line feed, or a blank line
                st.end()
                yield st.batch()
    return files.mapInArrow(run, R.SCHEMA)


def read_layout(spark: SparkSession, layout: CsvLayout, *, delimiter: str = ",", na_tokens: Sequence[str] = NA_TOKENS,
                with_row_index: bool = False, encoding: str = "UTF-8", file_col: str = SOURCE_FILE,
                problem_col: str | None = None, place_cols: tuple[str, str] | None = None,
                speculate: Observation | None = None, surveyed: tuple[R.Borders, list] | None = None) -> DataFrame:
    """All files of one layout as one DataFrame: kept columns under their labels
    (strings, NA tokens -> NULL), plus ``file_col`` (and ``row_idx``).

    Quoted line breaks are honoured like the job's reader. Files that may be
    split are scanned once beforehand for the state each split begins in
    (:func:`records.borders`), unless ``speculate`` is given: then every split
    begins a record, and the observation, once the rows have been read, tells
    of which files that was not so (:func:`misread`). ``problem_col`` names a
    column that says why a row makes its file unreadable, NULL for sound rows;
    ``place_cols`` names (split, place in it) columns, in the file's order.
    ``surveyed`` is :func:`records.survey` of the files, where that is known."""
    n, kind = len(layout.names), _kind(encoding)
    splits = [] if kind == "wide" else may_split(spark, _file_sizes(spark, layout.paths, layout.sizes))
    known = surveyed[0] if surveyed else R.borders(spark, splits, delimiter) if splits and speculate is None else R.Borders()
    rows = _wide_rows(spark, layout.paths, delimiter, encoding) if kind == "wide" else R.records(spark, layout.paths, delimiter, known)
    if speculate is not None:
        rows = rows.observe(speculate, F.collect_set(R.edge_of()).alias("edges"))   # one per split
    rows = rows.where(F.col(R.KIND).isin(R.RECORD, R.OPEN))
    files = R.file_table(spark, layout.paths, file_col)
    if len(layout.paths) * 512 <= broadcast_threshold(spark):
        files = F.broadcast(files)
    rows = rows.withColumn(_TEXT, F.decode(F.col(R.RAW), encoding) if kind == "bytes" else F.col(R.RAW).cast("string")).join(files, R.FID)
    schema = ", ".join(f"_c{i} string" for i in range(n)) + f", {_BAD} string"
    rows = rows.withColumn(_CELLS, F.from_csv(F.col(_TEXT), schema, {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE",
                                                                     "columnNameOfCorruptRecord": _BAD, "maxColumns": str(max(20480, 2 * n))}))
    rows = rows.select("*", f"{_CELLS}.*")
    cols = [na_to_null(f"_c{i}", list(na_tokens)).alias(layout.names[i]) for i in layout.kept]
    extra = [F.col(file_col)]
    if problem_col:
        long_row = F.col(_BAD).isNotNull() & (_fields(F.col(_TEXT), delimiter) > n)
        unreadable = ~F.expr(f"is_valid_utf8({R.RAW})") if kind == "utf8" else F.col(_TEXT).contains("�")
        extra.append(F.when(F.col(R.KIND) == R.OPEN, F.lit("a quoted cell is not closed"))
                     .when(long_row, F.lit(f"a row has more fields than the header's {n}"))
                     .when(unreadable, F.lit(f"not {encoding} text")).alias(problem_col))
    if place_cols:
        extra += [F.col(R.BLOCK).alias(place_cols[0]), F.col(R.PLACE).alias(place_cols[1])]
    if with_row_index:
        rows, place = R.numbered(spark, rows, splits, delimiter, known, surveyed[1] if surveyed else None)
        extra.append(place.alias(ROW_IDX))
    return rows.select(*cols, *extra)


def misread(spark: SparkSession, layout: CsvLayout, speculate: Observation) -> list[str]:
    """Files of the layout of which a speculating scan, now done, took a split
    to begin a record that did not."""
    got = observed(speculate)
    if got is None:   # not observed: whatever may have been split
        return sorted(may_split(spark, _file_sizes(spark, layout.paths, layout.sizes)))
    odd = [fid for fid, c in R.courses(got["edges"] or []).items() if not c.as_speculated]
    if not odd:
        return []
    return sorted(r["p"] for r in R.file_table(spark, layout.paths, "p").where(F.col(R.FID).isin(odd)).collect())


def read_feeds(spark: SparkSession, directory: str, *, extensions: Sequence[str] = (".csv",),
               **read_opts) -> tuple[CsvFeeds, list[DataFrame]]:
    """Discover CSV feeds in ``directory`` and read each layout."""
    files = [f for f in list_feeds(spark, directory, extensions) if f.ext == ".csv"]
    zero = [(f.path, "empty file") for f in files if f.length == 0]
    feeds = csv_layouts(spark, [f.path for f in files if f.length > 0], sizes={f.path: f.length for f in files})
    feeds.failures[:0] = zero
    return feeds, [read_layout(spark, lay, **read_opts) for lay in feeds.layouts]


# What the job's reader takes for a number or a boolean (fixed values).
TYPE_PATTERNS = {
    "bigint": r"\A[ \t]*[+-]?[0-9]+[ \t]*\z",
    "double": r"\A[ \t]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*\z|\A[+-]?(?i:inf|infinity)\z",
    "boolean": r"\A(?:True|TRUE|true|False|FALSE|false)\z",
}


def infer_types(df: DataFrame, columns: Sequence[str] | None = None,
                candidates: Sequence[str] = ("bigint", "double", "boolean")) -> DataFrame:
    """Opt-in typed view of string columns (A8): one aggregate pass computes,
    per column and candidate type, whether every non-NULL value is written as
    the job's reader takes that type (:data:`TYPE_PATTERNS`) and casts; each
    column then takes the first candidate that fits, else stays string."""
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    if not columns:
        return df
    aggs = []
    for i, name in enumerate(columns):
        aggs.append(F.count(c(name)).alias(f"n{i}"))
        for j, t in enumerate(candidates):
            ok = c(name).rlike(TYPE_PATTERNS[t]) & F.expr(f"try_cast({_q(name)} AS {t})").isNotNull()
            aggs.append(F.count_if(ok).alias(f"n{i}_{j}"))
    stats = df.agg(*aggs).first()
    chosen = {}
    for i, name in enumerate(columns):
        n = stats[f"n{i}"]
        for j, t in enumerate(candidates):
            if n > 0 and stats[f"n{i}_{j}"] == n:
                chosen[name] = t
                break
    return df.select(*[
        F.expr(f"try_cast({_q(f.name)} AS {chosen[f.name]})").alias(f.name) if f.name in chosen else c(f.name)
        for f in df.schema.fields
    ])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
