"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "meterflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package expects; a cluster supplies its own sizes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # An hour of record keys for dedup outgrows the heap that the default store keeps its state on.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Telemetry time is UTC; every entry point calls this before it plans anything."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, which is a single machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = os.path.join(tempfile.gettempdir(), f"meterflow-{os.getpid()}")
    os.makedirs(fallback, exist_ok=True)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
