"""Header records on the executors (A4b, A9, C3 for very many files).

``header_table`` is one plan over a table of paths: tasks look at the files
they are dealt, validate them and read each CSV's first record, up to a bound.
Nothing but file metadata is read and no path is looped over on the driver;
layouts, key combinations and file lists are then grouped and joined like any
other table. Paths in a store that Python tasks cannot open (a scheme that
pyarrow has no file system for) are probed by the driver instead.
"""

from __future__ import annotations

import csv as _pycsv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv import header_names, kept_positions
from .files import MAX_HEADER_BYTES, Header, decode_header, read_header, validate

#: Schemes that tasks open by themselves.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")
HEADERS = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("reason", T.StringType()),
                        T.StructField("names", T.ArrayType(T.StringType())), T.StructField("kept", T.ArrayType(T.IntegerType()))])


def _open(path: str):
    """(file system, path in it) of a path as Spark lists it."""
    from pyarrow import fs
    scheme, _, rest = path.partition(":")
    if scheme == "file" or "/" in scheme or not rest:
        return fs.LocalFileSystem(), "/" + (rest if rest else path).lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


def look(path: str, encoding: str, delimiter: str) -> tuple[int | None, str | None, Header | None]:
    """(length, why it is no feed, its header record)."""
    from pyarrow import fs
    try:
        where, name = _open(path)
        info = where.get_file_info(name)
        if info.type == fs.FileType.NotFound:
            return None, "does not exist", None
        if info.type != fs.FileType.File:
            return None, "not a file", None
        if info.size == 0:
            return 0, "empty file", None
        for size in (1 << 16, MAX_HEADER_BYTES):
            with where.open_input_stream(name) as stream:
                data = stream.read(size)
            header, complete = decode_header(data, len(data) < size or len(data) == info.size, encoding, delimiter)
            if complete:
                return info.size, header.reason, header
        return info.size, f"no complete header in the first {MAX_HEADER_BYTES} bytes", None
    except _pycsv.Error as e:
        return None, f"no complete header: {e}", None
    except UnicodeDecodeError:
        return None, f"header is not {encoding} text", None
    except Exception as e:  # noqa: BLE001 - this file's failure, reported as such
        return None, f"unreadable: {type(e).__name__}", None


def _row(path: str, length, reason, header: Header | None):
    if header is None or header.labels is None:
        return path, length, reason, None, None
    names = header_names(header.labels)
    return path, length, None, names, kept_positions(names)


def header_table(files: DataFrame, *, encoding: str = "UTF-8", delimiter: str = ",", files_per_task: int = 200) -> DataFrame:
    """:data:`HEADERS` of the paths in ``files`` (a ``path`` column): length,
    labels and positions kept, or the reason why the path is no CSV feed."""
    spark = files.sparkSession
    paths = files.select("path")
    foreign = ~F.regexp_extract("path", r"^([A-Za-z0-9+.-]+):", 1).isin("", *SCHEMES)
    odd = [r["path"] for r in paths.where(foreign).collect()]   # none, but for stores that tasks cannot open
    n = max(1, -(-paths.count() // files_per_task))
    cores = spark.sparkContext.defaultParallelism

    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = [_row(p, *look(p, encoding, delimiter)) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
                 pa.array([r[3] for r in rows], pa.list_(pa.string())), pa.array([r[4] for r in rows], pa.list_(pa.int32()))], names=HEADERS.names)
    out = paths.where(~foreign).repartition(max(n, min(cores, 8))).mapInArrow(run, HEADERS)
    if not odd:
        return out
    probed = []
    for path, why in validate(spark, odd):
        header = read_header(spark, path, encoding, delimiter) if why is None else None
        probed.append(_row(path, None, why or header.reason, header))
    return out.unionByName(spark.createDataFrame(probed, HEADERS))


def path_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string")


def layout_headers(headers: DataFrame) -> DataFrame:
    """``(layout_id, pos, header)`` of every kept label, for
    :func:`plans.layouts.plan_layouts`; a layout is a file here."""
    rows = headers.where("names is not null").select(F.col("path").alias("layout_id"), "names", F.explode("kept").alias("pos"))
    return rows.select("layout_id", "pos", F.get(F.col("names"), F.col("pos")).alias("header"))
