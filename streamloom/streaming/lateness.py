"""Tumbling counts with allowed lateness and a side output, on a stream.

Spark drops late rows before user code can see them, so no watermark is declared. Each micro-batch is judged
against the watermark at its start; what must outlive the batch (largest event time, open windows) is
written beside the output, one folder per batch, so a replayed batch finds the state it started from.
With one arrival per batch the result is exact per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from streamloom.functions.clock import window_floor
from streamloom.streaming.run import write_batches

EMISSION = "url string, win_start bigint, win_end bigint, count bigint, kind string, batch_id bigint"
LATE = "user string, url string, timestamp bigint, batch_id bigint"
_OPEN = "url string, win_start bigint, win_end bigint, count bigint, fired boolean"
_WINDOWS = _OPEN + ", new boolean, late boolean, due boolean"
_MARK = "max_time bigint"


class LateTumblingCount:
    """Count clicks per url and tumbling window; late rows re-fire, later ones go to the side output."""

    def __init__(self, path: str, size_ms: int, delay_ms: int, lateness_ms: int):
        self.path, self.size, self.delay, self.lateness = path, size_ms, delay_ms, lateness_ms

    def writer(self, clicks: DataFrame, checkpoint: str) -> DataStreamWriter:
        return clicks.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)

    def _state(self, spark: SparkSession, batch_id: int) -> tuple[DataFrame, int | None]:
        """Open windows and the watermark after the batch before this one."""
        if batch_id < 1:
            return spark.createDataFrame([], _OPEN), None
        before = batch_id - 1
        mark = spark.read.schema(_MARK).parquet(f"{self.path}/mark/batch_id={before}").first()
        return spark.read.schema(_OPEN).parquet(f"{self.path}/open/batch_id={before}"), mark and mark["max_time"]

    def _watermark(self, max_time: int | None) -> int | None:
        return None if max_time is None else max_time - self.delay - 1

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held, max_time = self._state(spark, batch_id)
        before = F.lit(self._watermark(max_time)).cast("bigint")

        start = window_floor(F.col("timestamp"), self.size)
        rows = batch.select("user", "url", "timestamp", start.alias("win_start"), (start + self.size).alias("win_end")).persist()
        too_late = F.coalesce(F.col("win_end") - 1 + self.lateness <= before, F.lit(False))
        write_batches(rows.filter(too_late).select("user", "url", "timestamp"), batch_id, f"{self.path}/later")

        seen = rows.agg(F.max("timestamp").alias("t")).first()["t"]
        max_time = max((t for t in (max_time, seen) if t is not None), default=None)
        after = F.lit(self._watermark(max_time)).cast("bigint")

        fresh = rows.filter(~too_late).groupBy("url", "win_start", "win_end").agg(F.count(F.lit(1)).alias("count"))
        windows = (
            held.withColumn("new", F.lit(False))
            .unionByName(fresh.withColumns({"fired": F.lit(False), "new": F.lit(True)}))
            .groupBy("url", "win_start", "win_end")
            .agg(F.sum("count").alias("count"), F.max("fired").alias("fired"), F.max("new").alias("new"))
            .withColumn("late", F.coalesce(F.col("win_end") - 1 <= before, F.lit(False)) & F.col("new"))
            .withColumn("due", F.coalesce(F.col("win_end") - 1 <= after, F.lit(False)))
        )
        write_batches(windows, batch_id, f"{self.path}/windows")
        windows = spark.read.schema(_WINDOWS).parquet(f"{self.path}/windows/batch_id={batch_id}")

        kind = F.when(F.col("late"), "refire").when(F.col("due") & ~F.col("fired"), "first")
        out = windows.withColumn("kind", kind).filter("kind IS NOT NULL").select("url", "win_start", "win_end", "count", "kind")
        write_batches(out, batch_id, f"{self.path}/emitted")

        alive = ~F.coalesce(F.col("win_end") - 1 + self.lateness <= after, F.lit(False))
        still = windows.filter(alive).select("url", "win_start", "win_end", "count", (F.col("fired") | F.col("due")).alias("fired"))
        write_batches(still, batch_id, f"{self.path}/open")
        write_batches(spark.range(1).select(F.lit(max_time).cast("bigint").alias("max_time")), batch_id, f"{self.path}/mark")
        rows.unpersist()

    def emitted(self, spark: SparkSession, flush_after: int | None = None) -> DataFrame:
        """All emissions; with ``flush_after`` (the last batch) windows still open fire as the input ends."""
        out = spark.read.schema(EMISSION).parquet(f"{self.path}/emitted")
        if flush_after is None:
            return out
        held, _ = self._state(spark, flush_after + 1)
        rest = held.filter("NOT fired").select(
            "url", "win_start", "win_end", "count", F.lit("first").alias("kind"), F.lit(flush_after + 1).cast("bigint").alias("batch_id")
        )
        return out.unionByName(rest)

    def later(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LATE).parquet(f"{self.path}/later")
