"""The directory job: every feed file in a folder, enriched and reported.

Plan per run:

1. list the folder (metadata) and probe each CSV's header line;
2. group files by layout; a layout without a key combination fails all its
   files (R5); per remaining layout one scan + one enrich plan. Header labels
   are compared with their case (R24);
3. workbooks go through the workbook reader (one task per workbook, sheets as
   rows) and are enriched per sheet layout the same way;
4. layouts with the same keys share one first-per-key reference, built once
   per run (reduced by the union of their keys when that set is small) and
   persisted with its hash partitioning;
5. each layout is written once, in input order, to a staging folder; rows,
   matches and unreadable rows per file are observed on the way, and only the
   outputs of sound files are moved to ``run_id``/``output``/``sheet`` (output
   names follow the files' time stamps, so a re-run replaces exactly its own).
   Every split of a CSV was taken to begin a record; files of which the pass
   tells otherwise are read again with their true borders. A layout that
   cannot be read or written is tried again file by file, so one bad file
   costs no other;
6. the report is one row per file (status success/failed/error, rows,
   sheets, sheets_info, output, error, matched, unmatched).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.exprs import c
from .operators.kept import KeptReference, keep_reference
from .operators.enrich import (
    SharedReference, broadcast_threshold, enrich, feed_key_set, first_reference, plan_size_bytes, prepare,
    reference_signature,
)
from .plans.headers import MissingReferenceColumns, NoKeyColumns, check_reference, plan_layout
from .session import job_settings
from .sinks.staged import Seen, StagedOutput, Target, counts_by_plan, target_table
from .sinks.writers import output_names
from .sources.csv import CsvLayout, csv_layouts, misread, read_layout
from .sources.files import FeedFile, list_feeds, stat_feeds
from .spec import EnrichSpec

# the job's own columns; a feed may have columns of any other name
FILE, SHEET, FLAG, PROBLEM = "__ks_file", "__ks_sheet", "__ks_hit", "__ks_problem"
PLACE = ("__ks_part", "__ks_place")   # of a row in its file, in order

REPORT_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("sheets", T.IntegerType()),
    T.StructField("sheets_info", T.MapType(T.StringType(), T.LongType())),
    T.StructField("output", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("matched", T.LongType()),
    T.StructField("unmatched", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("failed_sheets", T.ArrayType(T.StringType())),
])


@dataclass
class JobResult:
    report: DataFrame
    summary: DataFrame
    frames: list[DataFrame] = field(default_factory=list)   # enriched layouts (lazy plans)


@dataclass
class Unit:
    """Files (or sheets) of one layout and how to read some of them: all in
    one go (``speculate``, for CSV) or, without, with their borders known."""
    paths: list[str]
    columns: Sequence[str]
    read: Callable[..., DataFrame]
    layout: CsvLayout | None = None
    sheets: Sequence[tuple[str, str, int]] = ()
    speculate: bool = True

    def some(self, paths: Sequence[str], speculate: bool = True) -> Unit:
        return replace(self, paths=list(paths), layout=self.layout and _only(self.layout, paths),
                       sheets=[s for s in self.sheets if s[0] in set(paths)], speculate=speculate)

    def split(self) -> list[Unit]:
        return [self.some([p], self.speculate) for p in self.paths]

    def targets(self, names: dict[str, str], starts: dict[str, int]) -> list[Target]:
        of = [(f, s) for f, s, _ in self.sheets] if self.sheets else [(p, None) for p in self.paths]
        return [Target(f, s, names[f], starts[f]) for f, s in of if f in set(self.paths)]


def _only(lay: CsvLayout, paths: Sequence[str]) -> CsvLayout:
    """The layout with some of its files."""
    return CsvLayout(lay.names, lay.kept, list(paths), {p: n for p, n in lay.sizes.items() if p in paths})


def _name() -> str:
    return uuid.uuid4().hex


def _text(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def _failure(path, status, reason):
    """A failed file reports the job's generic text; ``reason`` says why."""
    error = "Processing failed" if status == "failed" else reason
    return (path, status, None, None, None, None, error, None, None, reason, None)


def enrich_directory(spark: SparkSession, directory: str, reference: DataFrame | Callable[[], DataFrame], spec: EnrichSpec,
                     out: str | None = None, *, run_id: str | None = None, ts: datetime | None = None,
                     fmt: str = "csv", paths: Sequence[str] | None = None,
                     reduce_reference="auto", on_error: str = "raise", parallel_layouts: int = 4,
                     ordered: bool = True, kept: str | KeptReference | None = None) -> JobResult:
    """Enrich every supported feed in ``directory`` (or the given ``paths``).

    ``reference`` may be a function that opens it: a reference that cannot be
    opened ends the run with status ``db_error``.

    Failures of one file or layout (vanished, unreadable, no keys, a failed
    write) only fail its files. Without ``ts`` the time stamp in output names
    is the present, or, with a ``run_id`` (a batch that may be replayed), the
    latest modification time among the files. ``ordered`` writes each output in
    the order of its input, which costs one shuffle of the output; without it
    the order is the join's. ``kept`` is a folder in which the first-per-key
    reference is kept from run to run (:mod:`.operators.kept`). ``out`` may not lie in ``directory``. An unexpected error of the run itself raises (``on_error="raise"``, right for
    an orchestrated job) or, with ``on_error="report"``, ends the run with
    status ``critical_error`` and the file rows gathered so far."""
    rows: list[tuple] = []
    if out is not None and (out.rstrip("/") + "/").startswith(directory.rstrip("/") + "/"):
        raise ValueError("the output folder may not be or lie in the input folder")
    try:
        with job_settings(spark, **{"spark.sql.caseSensitive": "true"}):
            return _run_directory(spark, directory, reference, spec, out, rows, run_id=run_id, ts=ts, fmt=fmt,
                                  paths=paths, reduce_reference=reduce_reference,
                                  parallel_layouts=parallel_layouts, ordered=ordered, kept=keep_reference(kept))
    except Exception:
        if on_error != "report":
            raise
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
        return JobResult(report, run_summary(report, status="critical_error"))


def _run_directory(spark, directory, reference, spec, out, rows, *, run_id, ts, fmt, paths,
                   reduce_reference, parallel_layouts, ordered, kept) -> JobResult:
    if paths is None:
        files = list_feeds(spark, directory, spec.extensions)
    else:
        files, gone = stat_feeds(spark, paths)
        rows += [_failure(p, "failed", why) for p, why in gone]
    if ts is None:
        newest = max((f.modified for f in files), default=0)
        ts = datetime.fromtimestamp(newest / 1000, timezone.utc) if run_id else datetime.now()
    run_id = run_id or ts.strftime("%Y%m%d%H%M%S%f")
    if not files:
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
        return JobResult(report, run_summary(report))
    try:
        if callable(reference):
            reference = reference()
        ref_schema = reference.schema   # resolves the source (for JDBC: connects)
    except Exception as e:  # noqa: BLE001 - the run cannot look anything up
        rows += [_failure(f.path, "error", f"reference unavailable: {type(e).__name__}") for f in files]
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
        return JobResult(report, run_summary(report, status="db_error"))
    names = output_names([f.path for f in files], ts)
    csvs = [f for f in files if f.ext == ".csv"]
    books = [f for f in files if f.ext == ".xlsx"]
    for f in files:
        if f.ext not in (".csv", ".xlsx"):
            rows.append(_failure(f.path, "failed", f"unsupported feed format {f.ext}"))
        elif f.length == 0:
            rows.append(_failure(f.path, "failed", "empty file"))

    units: list[Unit] = []
    nonempty_sheets: dict[str, int] = {}   # workbook -> sheets with data rows
    layouts = csv_layouts(spark, [f.path for f in csvs if f.length > 0], sizes={f.path: f.length for f in csvs})
    for p, why in layouts.failures:
        rows.append(_failure(p, "failed", why))
    for lay in layouts.layouts:
        units.append(Unit(list(lay.paths), lay.columns, lambda unit, seen=None: read_layout(
            spark, unit.layout, file_col=FILE, problem_col=PROBLEM, place_cols=PLACE, speculate=seen), lay))

    if books:
        from .sources.workbook import read_workbooks
        wb = read_workbooks(spark, [f.path for f in books if f.length > 0], file_col=FILE, sheet_col=SHEET, place_cols=PLACE)
        for p, why in wb.failures:
            rows.append(_failure(p, "failed", why))
        for lay in wb.layouts:
            units.append(Unit(sorted(set(lay.paths)), lay.columns, lambda unit, seen=None, lay=lay: lay.frame.filter(
                F.col(FILE).isin(unit.paths)) if set(unit.paths) != set(lay.paths) else lay.frame, sheets=lay.sheets))
        for lay in wb.layouts:
            for p in lay.paths:
                nonempty_sheets[p] = nonempty_sheets.get(p, 0) + 1

    frames = []
    errored: set[str] = set()
    stats: dict[str, dict] = {}
    failed_sheets: dict[str, list] = {}

    ref_columns = list(reference.columns)   # a reference that breaks here ends the run
    # pass 1 (metadata): plan every layout; group by key signature. A layout of
    # several files that cannot be read is split into its files.
    planned = []
    groups: dict[tuple, dict] = {}
    waiting = list(units)
    while waiting:
        unit = waiting.pop(0)
        try:
            plan = plan_layout(unit.columns, spec)
        except NoKeyColumns as e:
            for p in unit.paths:
                sheets = [s for f, s, _ in unit.sheets if f == p]
                failed_sheets.setdefault(p, []).extend([(s, str(e)) for s in sheets] or [(None, str(e))])
            continue
        missing = [col for col, _ in plan.missing]
        try:
            check_reference(ref_columns, plan.keys, missing, spec.order_by)
            feed = unit.read(unit, Observation(_name()))   # speculating: the rows are read further down
            sig = None if plan.passthrough else reference_signature(feed.schema, plan, ref_schema)
            prep = None if sig is None else prepare(feed, ref_schema, spec, plan)
        except Exception as e:  # noqa: BLE001 - this layout's files, not the run
            if len(unit.paths) > 1 and not isinstance(e, MissingReferenceColumns):
                waiting += unit.split()
                continue
            for p in unit.paths:
                rows.append(_failure(p, "error" if isinstance(e, MissingReferenceColumns) else "failed", _text(e)))
                errored.add(p)
            continue
        planned.append((unit, feed, plan, sig, prep))

    for unit, feed, plan, sig, prep in planned:
        if sig is not None:
            g = groups.setdefault(sig, {"targets": [], "keys": [], "prep": prep})
            missing = [col for col, _ in plan.missing]
            g["targets"] = [t for t in spec.target_columns if t in set(g["targets"]) | set(missing)]
            g["keys"].append(feed_key_set(prep))

    # one first-per-key reference per signature, shared by its layouts: the
    # reference is scanned and shuffled once per run, not once per layout
    shared: dict[tuple, SharedReference] = {}
    for sig, g in groups.items():
        if kept is not None:
            shared[sig] = kept.shared(reference, spec, g["prep"].ref_exprs, g["targets"])
            continue

        def build(reduce_mode, reduced, g=g):
            keys = reduce(lambda a, b: a.unionByName(b), g["keys"]).distinct()
            first = first_reference(reference, spec, g["prep"].ref_exprs, g["targets"], keys, reduce_mode, reduced)
            first = first.persist(StorageLevel.MEMORY_AND_DISK)
            first.count()   # materialise once; the cached relation now reports its exact size
            return first
        reduced: list = []
        try:
            first = build(reduce_reference, reduced)
        except Exception:  # noqa: BLE001 - a feed of the group cannot be read: its own unit will tell
            if reduce_reference is False:
                raise
            reduced = []
            first = build(False, reduced)
        small = 0 <= plan_size_bytes(first) <= broadcast_threshold(spark)
        shared[sig] = SharedReference(first, tuple(g["targets"]), broadcast=small, whole=not reduced)

    # pass 2: per layout one join and one write, which also counts. Layouts run
    # concurrently (Spark schedules jobs from several driver threads); each
    # writes to a folder of its own, so concurrent writes do not collide.
    lengths = {f.path: f.length for f in files}
    starts, total = {}, 0
    for f in files:
        starts[f.path] = total
        total += f.length
    staged = None if out is None else StagedOutput(spark, out, run_id, fmt)
    manifest: list[tuple] = []

    def process(unit, plan, sig):
        """[(unit, plan, frame, targets, what was seen of them, bad files, error)]"""
        try:
            spec_seen = Observation(_name()) if unit.layout is not None and unit.speculate else None
            feed = unit.read(unit, spec_seen)
            prep = prepare(feed, ref_schema, spec, plan) if sig is not None else None
            # a file read again may hold keys that a reduced reference was not reduced to
            one = shared.get(sig)
            one = one if one is not None and (unit.speculate or one.whole) else None
            enriched = enrich(feed, reference, spec, plan=plan, flag=FLAG, shared=one, prepared=prep)
            for name, kind in ((FLAG, "boolean"), (SHEET, "string"), (PROBLEM, "string")):
                if name not in enriched.columns:
                    enriched = enriched.withColumn(name, F.lit(None).cast(kind))
            targets = unit.targets(names, starts)
            data_cols = [n for n in enriched.columns if n not in (FILE, SHEET, FLAG, PROBLEM, *PLACE)]
            if staged is None:
                by = [FILE, SHEET] if unit.sheets else [FILE]
                table = target_table(spark, targets, FILE, SHEET if unit.sheets else "__ks_no_sheet")
                seen = counts_by_plan(enriched.join(table, by), targets, FLAG, PROBLEM)
                folder = None
            else:
                first = min(starts[p] for p in unit.paths)
                span = sum(lengths[p] for p in unit.paths)
                at, offset = {}, 0
                for p in sorted(unit.paths, key=starts.get):
                    at[p], offset = offset, offset + lengths[p]
                folder, seen = staged.write(
                    enriched, [replace(t, start=at[t.file]) for t in targets], file_col=FILE, sheet_col=SHEET, flag=FLAG, problem=PROBLEM,
                    place=PLACE, bytes_total=span, data_columns=data_cols, ordered=ordered)
            again = misread(spark, unit.layout, spec_seen) if spec_seen is not None else []
            frame = enriched.drop(FLAG, PROBLEM, *PLACE)
            bad = {}
            for t, s in zip(targets, seen):
                if s.problem is not None:
                    bad[t.file] = max(bad.get(t.file, ""), s.problem)
            right = [p for p in unit.paths if p not in again]
            done = []
            if again:   # files whose records lie across splits in ways the pass could not know
                done += process(unit.some(again, speculate=False), plan, sig)
            bad = {p: why for p, why in bad.items() if p in right}
            if staged is not None:
                staged.commit(folder, {names[p] for p in right if p not in bad})
                manifest.extend((t.output, t.sheet, t.file, data_cols, s.rows, fmt) for t, s in zip(targets, seen)
                                if t.file in right and t.file not in bad)
            kept = [(t, s) for t, s in zip(targets, seen) if t.file in right]
            return done + [(unit.some(right), plan, frame, kept, bad, None)]
        except Exception as e:  # noqa: BLE001 - a failed write or read fails its files (R21, R23)
            if len(unit.paths) > 1:   # one of the files: each on its own
                return [x for one in unit.split() for x in process(one, plan, sig)]
            return [(unit, plan, None, [], {}, _text(e))]

    try:
        workers = max(1, min(parallel_layouts, len(planned)))
        with ThreadPoolExecutor(max_workers=workers) as pool:
            results = [x for done in pool.map(lambda u: process(u[0], u[2], u[3]), planned) for x in done]
        if staged is not None:
            staged.finish(manifest)
    finally:
        for ref_first in shared.values():
            ref_first.frame.unpersist()
        if staged is not None:
            staged.discard()

    looked_up: set[str] = set()
    for unit, plan, frame, kept, bad, err in results:
        if frame is not None:
            frames.append(frame)
        if err is not None:
            for p in unit.paths:
                rows.append(_failure(p, "error", err))
                errored.add(p)
            continue
        for p, why in bad.items():
            if p not in errored:
                rows.append(_failure(p, "failed", why))
                errored.add(p)
        if not plan.passthrough:
            looked_up.update(unit.paths)
        for t, seen in kept:
            st = stats.setdefault(t.file, {"rows": 0, "matched": 0, "sheets": {}})
            st["rows"] += seen.rows
            st["matched"] += seen.hits
            if t.sheet is not None and seen.rows:
                st["sheets"][t.sheet] = st["sheets"].get(t.sheet, 0) + seen.rows
        for p in unit.paths:   # files of this layout that produced no row (header only)
            stats.setdefault(p, {"rows": 0, "matched": 0, "sheets": {}})

    for p in errored:
        stats.pop(p, None)
    for p, errs in failed_sheets.items():
        if p not in stats and p not in errored:
            rows.append(_failure(p, "failed", "; ".join(sorted({e for _, e in errs}))))
    for p, s in stats.items():
        # a workbook with one non-empty sheet is a plain table: no sheet breakdown
        sheets = s["sheets"] if nonempty_sheets.get(p, 0) > 1 else {}
        dropped = sorted(sheet for sheet, _ in failed_sheets.get(p, []) if sheet is not None) or None
        # a feed that lacks no target is not looked up: neither matched nor unmatched
        hits = (s["matched"], s["rows"] - s["matched"]) if p in looked_up else (None, None)
        rows.append((p, "success", s["rows"], len(sheets) if sheets else None, sheets or None,
                     names.get(p), None, *hits, None, dropped))

    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    return JobResult(report, run_summary(report), frames)


def run_summary(report: DataFrame, status: str = "completed") -> DataFrame:
    """Run totals (F7) and severity class (F8) over the report rows."""
    agg = report.agg(F.count_if(F.col("status") == "success").alias("processed"),
                     F.count_if(F.col("status") != "success").alias("errors"),
                     F.count(F.lit(1)).alias("total_files"))
    status_col = F.lit(status)
    if status == "completed":
        status_col = F.when(F.col("total_files") == 0, F.lit("no_files")).otherwise(status_col)
    return agg.select(status_col.alias("status"), "processed", "errors", "total_files",
                      run_color(status_col, F.col("errors")).alias("color"))


def run_color(status, errors):
    return (F.when((status == "completed") & (errors == 0), F.lit("green"))
            .when(status == "completed", F.lit("orange")).otherwise(F.lit("red")))
