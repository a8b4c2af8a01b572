"""Reference tables that change while a stream runs: a micro-batch works with one version, and a replay with the same one.

A version is a whole snapshot in a folder of its own and counts once its write has ended. Before a micro-batch does anything, the
version it is to use is written below the checkpoint; a batch that is run again finds it there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamloom.streaming.run import write_batches


def finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``name=<number>`` of ``path`` whose write has ended."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


class VersionedTable:
    """Snapshots of a table below ``path``, numbered from 0; readers see whole snapshots only."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def publish(self, rows: DataFrame) -> int:
        """Write the next version and return its number. One writer at a time."""
        version = self.newest() + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return version

    def newest(self) -> int:
        """The newest whole version, -1 if there is none."""
        return max(finished(self.spark, self.path, "version"), default=-1)

    def at(self, version: int) -> DataFrame:
        """The rows of a version; none of version -1."""
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={version}")

    def bound(self, bindings: str, batch_id: int) -> int:
        """The version of a micro-batch: the one written for it below ``bindings``, or else the newest, which is then written."""
        folder = f"{bindings}/batch_id={batch_id}"
        if batch_id in finished(self.spark, bindings, "batch_id"):
            return self.spark.read.schema("version bigint").parquet(folder).first()[0]
        version = self.newest()
        self.spark.range(1).selectExpr(f"CAST({version} AS BIGINT) AS version").write.mode("overwrite").parquet(folder)
        return version


def start_versioned(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", *, reference: VersionedTable, work: Callable[[DataFrame, DataFrame], DataFrame], **trigger,
) -> StreamingQuery:
    """Start writing ``work(batch, reference as of the batch)`` of every micro-batch below ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        version = reference.bound(f"{checkpoint}/reference-versions", batch_id)
        write_batches(work(batch, reference.at(version)), batch_id, path)

    return (
        stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
