"""Staged commit of a run's outputs.

A unit's rows are written once, into a staging folder below the output folder,
in input order: rows go to tasks by their place in the inputs (a partition
number, so no sampling pass) and are sorted by it within a task; the part
files of an output, by name, hold its rows in order. What the report needs is
observed in the same pass. Then only the outputs of sound files are moved to
``run_id=<run>/output=<name>/sheet=<sheet>``; a replayed batch replaces its
own. Those folder names are the same for all files, whatever columns they have.

Rows per output are counted by a sketch of as many items as there are outputs,
of which a task holds only those it has rows of: as rows are observed where
they are dealt by place, what reaches the driver grows with the outputs and the
tasks, not with their product. When the counts of all outputs add up to the
number of rows, each is exact; else, and where the adaptive plan found nothing
to write and so observed nothing, the plan is counted once more.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import c
from ..operators.enrich import broadcast_threshold
from ..session import observed
from .writers import csv_options, partition_names

RUN, OUTPUT, SHEET_DIR = "run_id", "output", "sheet"
MANIFEST = "_manifest"   # behind the output folder's own name
_NO, _START = "__ks_no", "__ks_start"
MAX_ITEMS = 1_000_000   # that a sketch keeps; more outputs are counted by the plan


@dataclass(frozen=True)
class Target:
    """One written output: a file or a sheet of it. ``start``: bytes of the
    files before this one, in the order of the listing."""
    file: str
    sheet: str | None
    output: str
    start: int


@dataclass(frozen=True)
class Seen:
    """What a pass saw of a target."""
    rows: int
    hits: int
    problem: str | None


def target_table(spark: SparkSession, targets: Sequence[Target], file_col: str, sheet_col: str) -> DataFrame:
    rows = [(t.file, t.sheet, i, t.output, t.start) for i, t in enumerate(targets)]
    table = spark.createDataFrame(rows, f"`{file_col}` string, `{sheet_col}` string, {_NO} int, __ks_output string, {_START} long")
    return F.broadcast(table) if len(rows) * 512 <= broadcast_threshold(spark) else table


def _observed(df: DataFrame, n: int, flag: str, problem: str, seen: Observation) -> DataFrame:
    items = n + 1   # NULL is an item too
    sketch = lambda x: F.expr(f"approx_top_k({x}, {items}, {items})") if items <= MAX_ITEMS else F.expr(f"count({x})")
    return df.observe(seen, sketch(_NO).alias("rows"), sketch(f"if(`{flag}`, {_NO}, null)").alias("hits"), F.count(F.lit(1)).alias("n"),
                      F.count_if(F.col(flag)).alias("m"),
                      F.collect_set(F.when(F.col(problem).isNotNull(), F.struct(F.col(_NO).alias("no"), F.col(problem).alias("why")))).alias("problems"))


def _exact(spark: SparkSession, got: dict, n: int) -> tuple[list[int], list[int]] | None:
    out = []
    for name, total in (("rows", "n"), ("hits", "m")):
        counts = [0] * n
        for item in got[name] or [] if n < MAX_ITEMS else []:
            if item["item"] is not None:
                counts[item["item"]] = item["count"]
        if sum(counts) != got[total]:
            return None
        out.append(counts)
    return out[0], out[1]


def counts_by_plan(df: DataFrame, targets: Sequence[Target], flag: str, problem: str) -> list[Seen]:
    """The same from an aggregate over the rows: one row per target reaches the driver."""
    per = df.groupBy(_NO).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(flag)).alias("m"), F.max(problem).alias("why")).collect()
    found = {r[_NO]: Seen(r["n"], r["m"], r["why"]) for r in per}
    return [found.get(i, Seen(0, 0, None)) for i in range(len(targets))]


class StagedOutput:
    """Outputs of one run below ``out``."""

    def __init__(self, spark: SparkSession, out: str, run_id: str, fmt: str):
        self.spark, self.out, self.run_id, self.fmt = spark, out.rstrip("/"), run_id, fmt
        self.staging = f"{self.out}/_staging-{uuid.uuid4().hex}"

    def _fs(self, path: str):
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def write(self, rows: DataFrame, targets: Sequence[Target], *, file_col: str, sheet_col: str, flag: str, problem: str,
              place: tuple[str, str], bytes_total: int, data_columns: Sequence[str], ordered: bool = True) -> tuple[str, list[Seen]]:
        """Write ``rows`` to a folder of their own below the staging folder:
        (the folder, what was seen of each target)."""
        spark, n = self.spark, len(targets)
        by_sheet = any(t.sheet is not None for t in targets)
        table = target_table(spark, targets, file_col, sheet_col if by_sheet else "__ks_no_sheet")
        named = rows.join(table, [file_col, sheet_col] if by_sheet else [file_col])
        seen = Observation(uuid.uuid4().hex)
        sheet = c(sheet_col) if by_sheet else c("__ks_no_sheet")   # a column of its own: a constant would be sorted by once more
        parts = partition_names(data_columns, (OUTPUT, SHEET_DIR))
        if ordered:
            size = self._task_bytes(bytes_total)
            at = F.least(F.floor((F.col(_START) + c(place[0])) / size), F.lit(max(0, bytes_total // size))).cast("int")
            named = named.repartitionById(max(1, bytes_total // size + 1), at)
        named = _observed(named, n, flag, problem, seen)   # a task has rows of few targets here
        named = named.select(*[c(x) for x in data_columns], c("__ks_output").alias(parts[OUTPUT]), sheet.alias(parts[SHEET_DIR]), *[c(p) for p in place])
        if ordered:
            named = named.sortWithinPartitions(c(parts[OUTPUT]), c(parts[SHEET_DIR]), *[c(p) for p in place])
        folder = f"{self.staging}/{uuid.uuid4().hex}"
        w = named.drop(*place).write.partitionBy(parts[OUTPUT], parts[SHEET_DIR])
        (csv_options(w.option("header", True)) if self.fmt == "csv" else w).format(self.fmt).save(folder)
        got = observed(seen)
        exact = None if got is None else _exact(spark, got, n)
        if exact is None:
            return folder, counts_by_plan(rows.join(table, [file_col, sheet_col] if by_sheet else [file_col]), targets, flag, problem)
        why: dict[int, str] = {}
        for p in got["problems"] or []:
            why[p["no"]] = max(why.get(p["no"], ""), p["why"])
        return folder, [Seen(exact[0][i], exact[1][i], why.get(i)) for i in range(n)]

    def _task_bytes(self, total: int) -> int:
        """Input bytes whose rows one task writes, as a scan would deal them."""
        spark = self.spark
        tasks = max(1, spark.sparkContext.defaultParallelism)
        return max(1 << 20, min(128 << 20, -(-total // tasks)))

    def commit(self, folder: str, outputs: set[str], threads: int = 16) -> None:
        """Move the given outputs from a written folder to their place."""
        target = f"{self.out}/{RUN}={_escape(self.run_id)}"
        fs, jfolder = self._fs(folder)
        if not fs.exists(jfolder):
            return
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(path(target))
        found = [st.getPath() for st in fs.listStatus(jfolder) if st.isDirectory()]

        def move(src):
            name = src.getName().split("=", 1)[1]
            if unquote(name) not in outputs:
                return
            for sheet in fs.listStatus(src):   # the folder's own name for the sheet may differ
                d = sheet.getPath()
                if sheet.isDirectory() and not d.getName().startswith(f"{SHEET_DIR}="):
                    self._rename(fs, d, path(src, f"{SHEET_DIR}={d.getName().split('=', 1)[1]}"))
            dst = path(f"{target}/{OUTPUT}={name}")
            if fs.exists(dst):
                fs.delete(dst, True)
            self._rename(fs, src, dst)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            list(pool.map(move, found))

    @staticmethod
    def _rename(fs, src, dst) -> None:
        if not fs.rename(src, dst):
            raise OSError(f"cannot move {src} to {dst}")

    def finish(self, manifest: Sequence[tuple]) -> None:
        """Write the run's manifest (see :data:`MANIFEST_SCHEMA`) and remove the staging folder."""
        spark = self.spark
        path = f"{self.out}{MANIFEST}/{RUN}={_escape(self.run_id)}"
        spark.createDataFrame(list(manifest), MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
        self.discard()

    def discard(self) -> None:
        fs, staging = self._fs(self.staging)
        if fs.exists(staging):
            fs.delete(staging, True)


MANIFEST_SCHEMA = T.StructType([
    T.StructField("output", T.StringType()), T.StructField("sheet", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())), T.StructField("rows", T.LongType()), T.StructField("format", T.StringType())])


def _escape(value: str) -> str:
    """A partition value as Spark writes it."""
    return "".join(x if x.isalnum() or x in "-_.~ +,;@!$&()" else "".join(f"%{b:02X}" for b in x.encode()) for x in value)


def read_manifest(spark: SparkSession, out: str, run_id: str | None = None) -> DataFrame:
    """The manifests of all runs (or one): ``run_id`` and :data:`MANIFEST_SCHEMA`."""
    schema = T.StructType(MANIFEST_SCHEMA.fields + [T.StructField(RUN, T.StringType())])
    table = spark.read.schema(schema).parquet(f"{out.rstrip('/')}{MANIFEST}")
    return table if run_id is None else table.where(F.col(RUN) == run_id)


def read_outputs(spark: SparkSession, out: str, run_id: str) -> list[tuple[list[str], DataFrame]]:
    """A run's outputs, one DataFrame per set of columns (text, as written)
    with ``__ks_output``, ``__ks_sheet`` and ``__ks_row``, the row's place in
    its output: (columns, rows)."""
    from ..sources import records as R
    from ..sources.csv import CsvLayout, read_layout
    groups: dict[tuple, list] = {}
    for r in read_manifest(spark, out, run_id).where("rows > 0").collect():   # one row per written output
        groups.setdefault((tuple(r["columns"]), r["format"]), []).append(r)
    done = []
    for (columns, fmt), rows in groups.items():
        if fmt != "csv":
            raise ValueError(f"outputs written as {fmt}: read them with spark.read")
        paths, table = [], []
        for r in rows:
            sheet = "__HIVE_DEFAULT_PARTITION__" if r["sheet"] is None else _escape(r["sheet"])
            folder = f"{out.rstrip('/')}/{RUN}={_escape(run_id)}/{OUTPUT}={_escape(r['output'])}/{SHEET_DIR}={sheet}"
            fs, jp = StagedOutput(spark, out, run_id, fmt)._fs(folder)
            for i, st in enumerate(sorted((s for s in fs.listStatus(jp) if s.isFile() and s.getLen() > 0 and not s.getPath().getName().startswith(("_", "."))),
                                          key=lambda s: s.getPath().getName())):
                p = st.getPath().toString()
                paths.append((p, int(st.getLen())))
                table.append((p, i, r["output"], r["sheet"]))
        lay = CsvLayout(tuple(f"c{i}" for i in range(len(columns))), tuple(range(len(columns))), [p for p, _ in paths], dict(paths))
        known, counts = R.survey(spark, lay.paths)   # one pass tells the rows of every split, and so of every part file
        df = read_layout(spark, lay, na_tokens=[""], with_row_index=True, file_col="__ks_part", surveyed=(known, counts))
        parts = spark.createDataFrame(table, "__ks_part string, __ks_i int, __ks_output string, __ks_sheet string")
        sizes = spark.createDataFrame(counts, f"{R.FID} long, __ks_blk long, __ks_rows long").groupBy(R.FID).agg(F.sum("__ks_rows").alias("__ks_n"))
        sizes = sizes.where("__ks_n > 0").join(R.file_table(spark, lay.paths, "__ks_part"), R.FID).drop(R.FID).join(parts, "__ks_part")
        from pyspark.sql import Window
        w = Window.partitionBy("__ks_output", "__ks_sheet").orderBy("__ks_i").rowsBetween(Window.unboundedPreceding, -1)
        parts = sizes.withColumn("__ks_before", F.coalesce(F.sum("__ks_n").over(w), F.lit(0))).drop("__ks_n", "__ks_i")
        df = df.join(parts, "__ks_part")
        done.append((list(columns), df.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(columns)], "__ks_output", "__ks_sheet",
                                              (F.col("__ks_before") + F.col("row_idx")).alias("__ks_row"))))
    return done
