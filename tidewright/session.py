"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# The library computes hour and 5-minute keys with UTC arithmetic on wall-clock
# values, so the session zone is part of its contract.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Recording the Python call site of every column costs more than planning wide feature matrices.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Stream state larger than executor memory spills to local disk and is restored from the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidewright", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults this library expects.

    Local masters get one shuffle partition per core; on a cluster the
    deployment's own ``spark.sql.shuffle.partitions`` is left alone and AQE
    coalesces from there.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if master is not None and master.startswith("local"):
        settings["spark.sql.shuffle.partitions"] = str(_local_cores(master))
        settings["spark.ui.enabled"] = "false"
        settings["spark.driver.memory"] = "8g"
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _local_cores(master: str) -> int:
    inside = master.partition("[")[2].rstrip("]")
    if inside.isdigit():
        return int(inside)
    return os.cpu_count() or 1


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and table versions.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    has none gets a temporary one; a cluster without the setting is refused,
    because a machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tidewright-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below :func:`checkpoint_root`."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
