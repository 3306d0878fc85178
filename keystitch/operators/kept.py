"""A kept first-per-key reference.

A recurring job needs the first reference row per key in every batch. This
keeps it as a table: one row per key with its targets and tie-break columns,
in parquet files bucketed and sorted by the keys. A batch over an unchanged
reference joins that table as it is: nothing is ranked, and the table's side
of the join is not shuffled, as its buckets are the join's partitions.

When files have been added to the reference, only their rows are ranked; the
winners meet the kept rows bucket by bucket (again without a shuffle of these)
and the better row of each key stays. When files changed or went, or the
reference names no files (JDBC) and the caller's ``version`` differs, the table
is built anew. Each state is a folder of its own below ``path``; a small JSON
file, renamed into place, names the current one, so a run that breaks off
leaves the last state whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import c
from ..spec import EnrichSpec
from .enrich import _P, SharedReference, _and, _first_rows, order_columns

CURRENT = "_current.json"


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _read_json(spark: SparkSession, path: str) -> dict | None:
    fs, jp = _fs(spark, path)
    if not fs.exists(jp):
        return None
    stream = fs.open(jp)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Written beside, then renamed over the old one."""
    fs, jp = _fs(spark, path)
    tmp = _fs(spark, f"{path}.{uuid.uuid4().hex}")[1]
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    if fs.exists(jp):
        fs.delete(jp, False)
    if not fs.rename(tmp, jp):
        raise OSError(f"cannot write {path}")


def reference_files(reference: DataFrame) -> dict[str, list[int]] | None:
    """Files that a reference is read from, with length and time: None where it
    is not read from files."""
    spark = reference.sparkSession
    found = reference.inputFiles()
    if not found:
        return None
    out = {}
    for p in found:
        fs, jp = _fs(spark, p)
        if not fs.exists(jp):   # as the reader writes it: encoded
            jp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(p))
        st = fs.getFileStatus(jp)
        out[re.sub(r"^file:/+", "file:/", st.getPath().toUri().toString())] = [int(st.getLen()), int(st.getModificationTime())]   # as rows name their file
    return out


def _better(order_by: Sequence[str], ties: Sequence[str], a: str, b: str) -> Column:
    """Whether row ``a`` comes before row ``b`` in the tie-break's order."""
    out = F.lit(False)
    steps = [(f"{_P}o{m}", o.startswith("-")) for m, o in enumerate(order_by)] + [(f"{_P}x{m}", False) for m in range(len(ties))]
    for name, down in reversed(steps):
        x, y = F.col(f"{a}.{name}"), F.col(f"{b}.{name}")
        if down:   # nulls last
            first = y.isNull() & x.isNotNull() | (x > y)
        else:      # nulls first
            first = x.isNull() & y.isNotNull() | (x < y)
        out = F.when(F.coalesce(first, F.lit(False)), F.lit(True)).when(x.eqNullSafe(y), out).otherwise(F.lit(False))
    return out


@dataclass
class KeptReference:
    """First reference rows per key, kept below ``path`` in ``buckets`` buckets.
    ``version``: of a reference that is read from no files."""
    path: str
    buckets: int = 64
    version: str | None = None

    def shared(self, reference: DataFrame, spec: EnrichSpec, ref_exprs: Sequence[Column], targets: Sequence[str]) -> SharedReference:
        """The kept table, brought up to date, as the reference side of :func:`enrich`."""
        spark = reference.sparkSession
        ties = [t for t in spec.target_columns if t in reference.columns]
        kept = list(dict.fromkeys(ties + [t for t in targets if t not in ties]))
        rkeys = [f"{_P}r{i}" for i in range(len(ref_exprs))]
        signature = hashlib.sha256(json.dumps([[str(e) for e in ref_exprs], list(spec.order_by), kept, ties, self.buckets,
                                               reference.schema.json()]).encode()).hexdigest()[:16]
        root = f"{self.path.rstrip('/')}/{signature}"
        state = _read_json(spark, f"{root}/{CURRENT}")
        files = reference_files(reference)
        if state is None or not self._same(state, files):
            added = self._added(state, files)
            if added is None:
                rows = self._ranked(reference, spec, ref_exprs, rkeys, kept, ties)
            else:
                new = self._ranked(reference.where(F.col("_metadata.file_path").isin(added)), spec, ref_exprs, rkeys, kept, ties)
                rows = self._merged(self._table(spark, root, state), new, spec, rkeys, ties)
            state = self._write(spark, root, rows, rkeys, files)
        table = self._table(spark, root, state)
        place = {t: j for j, t in enumerate(kept)}
        frame = table.select(*rkeys, *[F.col(f"{_P}t{place[t]}").alias(f"{_P}t{j}") for j, t in enumerate(targets)], F.lit(True).alias(f"{_P}m"))
        return SharedReference(frame, tuple(targets))

    def _same(self, state: dict, files) -> bool:
        return state["files"] == files if files is not None else (self.version is not None and state["version"] == self.version)

    @staticmethod
    def _added(state: dict | None, files) -> list[str] | None:
        """Files that came since, None where that is not all that happened."""
        if state is None or files is None or not state["files"] or any(files.get(p) != v for p, v in state["files"].items()):
            return None
        return sorted(set(files) - set(state["files"]))

    @staticmethod
    def _ranked(reference: DataFrame, spec: EnrichSpec, ref_exprs, rkeys, kept, ties) -> DataFrame:
        names = [o.lstrip("-") for o in spec.order_by]
        ref = reference.select(*[e.alias(k) for e, k in zip(ref_exprs, rkeys)], *[c(t).alias(f"{_P}t{j}") for j, t in enumerate(kept)],
                               *[c(o).alias(f"{_P}o{m}") for m, o in enumerate(names)], *[c(t).alias(f"{_P}x{m}") for m, t in enumerate(ties)])
        ref = ref.where(_and([F.col(k).isNotNull() for k in rkeys]))
        order = order_columns([("-" if o.startswith("-") else "") + f"{_P}o{m}" for m, o in enumerate(spec.order_by)])
        order += [F.col(f"{_P}x{m}").asc_nulls_first() for m in range(len(ties))]
        return _first_rows(ref, rkeys, order or [F.lit(1)])

    @staticmethod
    def _merged(old: DataFrame, new: DataFrame, spec: EnrichSpec, rkeys, ties) -> DataFrame:
        both = old.alias("a").join(new.alias("b"), _and([F.col(f"a.{k}") == F.col(f"b.{k}") for k in rkeys]), "full_outer")
        first = F.col(f"a.{rkeys[0]}").isNotNull() & (F.col(f"b.{rkeys[0]}").isNull() | ~_better(spec.order_by, ties, "b", "a"))
        return both.select(*[F.when(first, F.col(f"a.{n}")).otherwise(F.col(f"b.{n}")).alias(n) for n in old.columns])

    def _write(self, spark: SparkSession, root: str, rows: DataFrame, rkeys, files) -> dict:
        state = uuid.uuid4().hex
        name = f"ks_kept_{state}"
        folder = f"{root}/{state}"
        _fs(spark, root)[0].mkdirs(_fs(spark, root)[1])
        # one task a bucket: one file each, so a reader need not sort
        (rows.repartition(self.buckets, *rkeys).sortWithinPartitions(*rkeys).write.format("parquet").bucketBy(self.buckets, *rkeys).sortBy(*rkeys)
         .option("path", folder).saveAsTable(name))
        value = {"state": state, "files": files, "version": self.version, "keys": list(rkeys), "buckets": self.buckets,
                 "schema": spark.table(name).schema.json()}
        _write_json(spark, f"{root}/{CURRENT}", value)
        return value

    @staticmethod
    def _table(spark: SparkSession, root: str, state: dict) -> DataFrame:
        """The kept files as the bucketed table they are, known to this session or not."""
        from pyspark.sql import types as T
        name = f"ks_kept_{state['state']}"
        if not spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(state["schema"])).fields)
            keys = ", ".join(f"`{k}`" for k in state["keys"])
            spark.sql(f"CREATE TABLE `{name}` ({cols}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {state['buckets']} BUCKETS "
                      f"LOCATION '{root}/{state['state']}'")
        return spark.table(name)


def keep_reference(path: str | KeptReference | None) -> KeptReference | None:
    return KeptReference(path) if isinstance(path, str) else path
