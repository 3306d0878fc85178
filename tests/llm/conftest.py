import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, spread over partitions."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def sample_docs():
    """Whole texts of the smallest given table."""
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    return [(10**6 + d, x, s) for d, x, s in zip(t["doc_id"], t["text"], t["source"])]


ODD = [
    (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "x" * 300_000), (6, "7" * 200_000),
    (7, "a." * 100_000 + "@" + "b." * 50_000), (8, "é\U0001F600 mit \U0001F600 license 1.2.3.4 é@x.yz"),
    (9, "@" * 5000), (10, "+1" * 5000), (11, "same words here " * 2000), (12, "line\n" * 3000),
]


@pytest.fixture(scope="session")
def odd_rows():
    return list(ODD)
