"""The corpus pipeline: quality classifier, near-duplicates, decontamination,
secrets, mixing. Each stage works on what its predecessor kept, written as
Parquet in the shared scratch folder and reread; all but the last return the
columns of ``documents``.

- ``quality_classifier`` drops documents scored under the classifier's cut;
- ``simhash_near_dedup`` keeps the smallest doc_id of each component;
- ``benchmark_decontamination`` drops documents that hold a copy of an item;
- ``secret_scan`` replaces each secret in the text by ``[SECRET]``;
- ``mix_sources`` adds ``size``, ``source_size``, ``target`` and
  ``repetitions``, and drops documents that the mix does not take.

Empty inputs give empty outputs; rows with a null doc_id are scored and mixed
like others and cannot be named as a duplicate or as contaminated; null texts
count as empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keystitch.llm import decontam, mixing, quality, secrets, simhash
from keystitch.llm.common import same_columns, table
from keystitch.session import scratch_path

# Trained models and near-duplicate components cannot be expressed in SQL; the
# run is tested against a brute-force version.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return same_columns(simhash.keep_one(docs, shingle=3, seed=42, max_bits=2), docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return same_columns(decontam.clean(docs, table(spark, sf_dir, "benchmark")), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return same_columns(secrets.redact(docs, secrets.train(docs)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where("repetitions > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is read from the last one's files."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
