"""Session helpers: a local session for tests/bench, and the shared scratch
folder (the cluster's ``spark.checkpoint.dir``) for lineage cuts and files a
job writes for itself."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import Observation, SparkSession

# Settings every job of this library relies on: AQE re-plans joins at run time
# (skew splits, partition coalescing) and broadcasts only from *measured*
# stage sizes; the static planner, whose estimates come from compressed file
# sizes, broadcasts nothing on its own.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "keystitch") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`JOB_CONF` to a session (runtime SQL settings only)."""
    for k, v in JOB_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs cannot change at run time
            pass
    return spark


@contextmanager
def job_settings(spark: SparkSession, **more: str):
    """:data:`JOB_CONF` (and ``more``) while a job runs; the caller's own
    settings are back when it ends."""
    wanted = {**JOB_CONF, **more}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def observed(observation: Observation) -> dict | None:
    """What an observation saw; None where the adaptive plan found the query
    empty and left it out."""
    try:
        return observation.get
    except Py4JError:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``. Only a local
    session that names none (tests) gets a fresh one: on a cluster a folder of
    one machine would be missing on the others."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="keystitch-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/keystitch/{name}-{uuid.uuid4().hex}"
