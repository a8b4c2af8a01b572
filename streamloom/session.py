"""Session settings shared by every job, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings: safe to apply to a session the cluster has already made.
# Partition counts, broadcast threshold and memory stay with the cluster.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, cpus: int | str = "*") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return _local_root[0]


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
