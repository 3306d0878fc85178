"""What the operators of this subpackage share: table access, lineage cuts,
whole-text batches for Python workers and a few row-local array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import scratch_path

#: A word: what the six ASCII white-space characters separate.
WORD = r"[^\x20\x09-\x0D]+"
#: Elements of an array that :func:`prefix` reduces in one go.
_BLOCK = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written once to the cluster's shared folder (spark.checkpoint.dir)
    and reread: the lineage ends there, a lost executor does not lose the rows,
    and nothing is computed twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = 20_000, max_bytes: int = 8 << 20) -> DataFrame:
    """``df`` marked for broadcast if it is within both bounds (it is counted),
    else as it is, for a shuffled join."""
    size = F.length(F.to_json(F.struct("*")))
    rows, chars = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and chars <= max_bytes else df


#: Texts that a Python worker is handed at once.
BATCH_ROWS = 1000


def in_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, with the session's Arrow batches at ``rows`` rows at most: a
    worker's memory follows the texts of one batch, and texts may be long."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    now = int(conf.get(key, "10000"))
    if not 0 < now <= rows:
        conf.set(key, str(rows))
    return df


def map_texts(docs: DataFrame, fn, fields: list[tuple[str, T.DataType]], id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: its id and the values that ``fn(text)`` returns as
    a tuple (null text: ''). Only the two columns reach the Python workers; the
    texts of a batch are taken one at a time."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType)]
                          + [T.StructField(n, t) for n, t in fields])
    names = [n for n, _ in fields]

    def run(batches):
        import pyarrow as pa
        arrow = _arrow_schema(schema)
        for b in batches:
            rows = [fn(t.as_py()) for t in b.column("t")]
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            arrays = [b.column("id").cast(arrow.field(0).type)]
            arrays += [pa.array(list(c), type=arrow.field(i + 1).type) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return in_batches(src).mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``value``, which is evaluated once (an
    expression named in a lambda would be evaluated for each element)."""
    return F.transform(F.array(value), body)[0]


def prefix(arr: Column, zero: Column, op) -> Column:
    """Exclusive prefix reduction of an array (element i: ``op`` over those
    before i). Blocks keep the work near-linear in the array's length."""
    def within(xs, n_blocks):
        sums = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.aggregate(F.slice(xs, b * _BLOCK + 1, _BLOCK), zero, op))
        return let(sums, lambda s: let(
            F.transform(s, lambda _, b: F.aggregate(F.slice(s, F.lit(1), b), zero, op)),
            lambda before: F.transform(xs, lambda _, i: op(
                F.get(before, F.floor(i / _BLOCK).cast("int")),
                F.aggregate(F.slice(xs, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK), zero, op)))))
    return F.when(F.size(arr) == 0, F.slice(arr, 1, 0)).otherwise(
        let(arr, lambda xs: let(F.ceil(F.size(xs) / _BLOCK).cast("int"), lambda n: within(xs, n))))


def matches(text: Column, pattern: Column, measure) -> Column:
    """All leftmost non-overlapping matches of a regular expression as
    ``array<struct<start, end, value>>``: positions are the summed ``measure``
    of what ``split`` leaves between the matches and of the matches."""
    long = lambda c: c.cast("long")

    def spans(found, between):
        sizes = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found,
                           lambda p, m: F.struct(long(measure(p)).alias("gap"), long(measure(m)).alias("n")))
        return let(sizes, lambda zs: let(
            prefix(F.transform(zs, lambda z: z["gap"] + z["n"]), F.lit(0).cast("long"), lambda a, b: a + b),
            lambda before: F.transform(found, lambda m, i: F.struct(
                (before[i] + zs[i]["gap"]).alias("start"),
                (before[i] + zs[i]["gap"] + zs[i]["n"]).alias("end"),
                m.alias("value")))))
    return let(F.regexp_extract_all(text, pattern, F.lit(0)),
               lambda found: let(F.split(text, pattern, -1), lambda between: spans(found, between)))


def bounded_sample(df: DataFrame, id_col: str, n: int, seed: str) -> DataFrame:
    """At most ``n`` rows, those whose seeded hash of the id is smallest: a
    sample that does not depend on how the rows are partitioned. Rows far above
    the n-th are dropped where they are read, so about ``n`` rows meet in one
    task however many there are; pass narrow rows."""
    total = df.count()
    rows = df.withColumn("__h", F.xxhash64(F.lit(seed), F.col(id_col)))
    if total > 4 * n:   # 1.5 n in the mean, so short of n practically never
        rows = rows.where(F.col("__h") < int(-(1 << 63) + (1 << 64) * (1.5 * n + 50) / total))
    return rows.orderBy("__h", id_col).limit(n).drop("__h")


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in like.columns])


__all__ = ["WORD", "table", "cut", "small", "map_texts", "in_batches", "let", "prefix", "matches", "bounded_sample", "same_columns"]
