"""Session settings and shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates and hours are derived from timestamps, so the zone is part of the result.
TIME_ZONE = "UTC"

SETTINGS = {
    "spark.sql.session.timeZone": TIME_ZONE,
    # Runtime re-planning does the work that would otherwise need per-query tuning: it sizes
    # shuffle partitions, splits skewed join partitions, and turns a shuffled join into a
    # broadcast once a side has proved small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile methods above 8000 bytes of bytecode; without this limit the wide
    # projections of message validation would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming state on disk: the state of a deduplication grows with the watermark delay.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "adlumen", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's settings; ``extra`` uses ``__`` for dots in names.

    ``spark.sql.shuffle.partitions`` is left to the cluster: with adaptive execution it is only
    the upper bound from which partitions are merged.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path for intermediate tables, on the storage all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. Where it is unset, a temporary
    folder of this machine serves a session that runs on this machine alone; on a cluster each
    executor would write to its own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="adlumen-")
    return f"{root.rstrip('/')}/adlumen/{name}-{uuid.uuid4().hex}"
