"""Run a stream to the end of its input into a table, exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from streamloom.operators.ranking import first_per_key
from streamloom.session import scratch


def write_batches(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch to a folder of its own; a replayed batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


#: The tables that the work on micro-batches keeps lie beside the folder of the output, under its name and this.
KEPT = "-kept"


def worked_by_batch(stream: DataFrame, work: Callable[[DataFrame, int, str], DataFrame], schema: StructType) -> DataFrame:
    """``stream`` with work of its own for each micro-batch: ``work(batch, batch_id, folder)`` gives the rows that are written, with the columns ``schema``.

    What the work keeps from batch to batch are tables below ``folder``; a batch that is run again must give what it gave before. The work goes with this
    DataFrame and not with others made from it: ``start_to_table`` does it, and so do ``run_to_table`` and ``feed_in_order`` by default.
    """
    stream._by_batch = (work, schema)
    return stream


def written_schema(stream: DataFrame) -> StructType:
    """The columns of what ``start_to_table`` writes."""
    return stream._by_batch[1] if hasattr(stream, "_by_batch") else stream.schema


def start_to_table(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
    finish: Callable[[DataFrame], DataFrame] | None = None, **trigger,
) -> StreamingQuery:
    """Start writing every micro-batch, after the stream's own work on it and ``finish``, below ``path``; default trigger: all that is available."""
    work = stream._by_batch[0] if hasattr(stream, "_by_batch") else None

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = work(batch, batch_id, f"{path}{KEPT}") if work else batch
        write_batches(finish(rows) if finish else rows, batch_id, path)

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything written below ``path``, with the ``batch_id`` it came from."""
    return spark.read.schema(StructType([*schema.fields]).add("batch_id", LongType())).parquet(path)


class EndMark:
    """Far-future rows that close all windows of a bounded input, once every micro-batch of it has been read.

    ``on`` adds a source that is empty at first; ``run_to_table`` runs the stream over its whole input, however many micro-batches
    that takes, then writes the rows and runs it again from its checkpoint. So no row of the input meets a watermark that a mark has moved.
    """

    AT = "9000-01-01 00:00:00"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.sources: list[tuple[DataFrame, str]] = []

    def on(self, stream: DataFrame, time: str) -> DataFrame:
        """The stream and its mark: NULL but for ``time`` (a date, timestamp or milliseconds). Apply it before ``withWatermark``; the window of a mark never closes."""
        path = scratch(self.spark, "end-mark")
        at = F.lit(self.AT).cast("timestamp")
        row = self.spark.range(1).select(*[
            ((F.unix_millis(at) if f.dataType == LongType() else at.cast(f.dataType)) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in stream.schema.fields
        ])
        row.limit(0).write.parquet(path)
        self.sources.append((row, path))
        return stream.unionByName(self.spark.readStream.schema(stream.schema).parquet(path))

    def write(self) -> None:
        for row, path in self.sources:
            row.write.mode("append").parquet(path)

    def run(self, start: Callable[[], StreamingQuery]) -> None:
        """Start the query, wait for the end of its input, write the marks, and start it again."""
        start().awaitTermination()
        self.write()
        start().awaitTermination()


def run_to_table(stream: DataFrame, mode: str = "append", end: EndMark | None = None) -> DataFrame:
    """Run the stream over what its source holds now and read the output back, with ``batch_id``."""
    spark = stream.sparkSession
    path, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-checkpoint")
    start = lambda: start_to_table(stream, path, checkpoint, mode)
    if end:
        end.run(start)
    else:
        start().awaitTermination()
    return read_batches(spark, path, written_schema(stream))


def feed_in_order(
    spark: SparkSession, tables: list[tuple[DataFrame, str]], parts: int, make: Callable[..., DataFrame], mode: str = "append",
    marks: list[dict | None] | None = None, start: Callable[..., StreamingQuery] = start_to_table, schema: str | StructType | None = None,
    before: Callable[[int], None] | None = None,
) -> DataFrame:
    """Feed tables as streams, ``parts`` micro-batches in the order of a whole number each, and read back what ``make(*streams)`` gives, with ``batch_id``.

    ``tables`` has (table, number). The span of all numbers is cut into equal parts, and ``part_of`` says which one a row is in. The rows are written
    once, a folder for each part, and before each micro-batch its folders are moved to where the streams read; the query is then started from its checkpoint and stops when it has read them, so every part also
    is a restart. ``marks`` has for each table the values of a last row (the rest is NULL), or nothing: it closes windows in an additional micro-batch.
    ``start(stream, path, checkpoint, mode)`` starts the query, with ``schema`` the columns it writes if they are not the stream's; ``before(part)`` is called before the rows of a part come.
    Rows whose number is NULL come with the first part.
    """
    spans = [df.agg(F.min(seq), F.max(seq)).first() for df, seq in tables]
    known = [s for s in spans if s[0] is not None]
    low, high = (min(s[0] for s in known), max(s[1] for s in known)) if known else (0, 0)
    folders, cut = [], []
    place = spark._jvm.org.apache.hadoop.fs.Path
    for df, seq in tables:
        whole, folder = scratch(spark, "parts"), scratch(spark, "feed")
        df.withColumn("__part", F.coalesce(part_of(F.col(seq), low, high, parts), F.lit(0))).write.partitionBy("__part").parquet(whole)
        df.limit(0).write.parquet(folder)
        cut.append(whole)
        folders.append(folder)
    stream = make(*[spark.readStream.schema(df.schema).option("recursiveFileLookup", True).parquet(folder) for (df, _), folder in zip(tables, folders)])
    path, checkpoint = scratch(spark, "stream-out"), scratch(spark, "stream-checkpoint")
    for part in range(parts):
        if before:
            before(part)
        for whole, folder in zip(cut, folders):
            rows = place(f"{whole}/__part={part}")
            files = rows.getFileSystem(spark._jsc.hadoopConfiguration())
            if files.exists(rows) and not files.rename(rows, place(f"{folder}/part-{part}")):
                raise OSError(f"{rows} could not be moved to {folder}")
        start(stream, path, checkpoint, mode).awaitTermination()
    if marks:
        for (df, _), mark, folder in zip(tables, marks, folders):
            if mark:
                values = [F.lit(mark.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
                spark.range(1).select(*values).write.mode("append").parquet(folder)
        start(stream, path, checkpoint, mode).awaitTermination()
    return read_batches(spark, path, StructType.fromDDL(schema) if isinstance(schema, str) else schema or written_schema(stream))


def part_of(seq, low: int, high: int, parts: int):
    """Which of ``parts`` equal stretches from ``low`` to ``high`` a number is in."""
    return F.floor((seq - F.lit(low)) * F.lit(parts) / F.lit(high - low + 1)).cast("bigint")


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Last update per key of an update-mode stream."""
    return first_per_key(updates, keys, [F.col("batch_id").desc()]).drop("batch_id")


def run_latest(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Final values of an update-mode aggregation."""
    return latest(run_to_table(stream, "update"), keys)
