"""Where streams go. Each function starts nothing until ``start``; checkpoints give exactly-once files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from streamloom.operators.ranking import first_per_key
from streamloom.shipping import ship_by_value
from streamloom.streaming.run import write_batches
from streamloom.streaming.versions import finished

ship_by_value(__name__)


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows as text with the label of their stream."""
    return df.select(F.lit(label).alias("label"), F.to_json(F.struct("*")).alias("value"))


def sink_labelled(stream: DataFrame, label: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the stream's rows under its label."""
    return (
        labelled(stream, label).writeStream
        .foreachBatch(lambda batch, batch_id: write_batches(batch, batch_id, f"{path}/stream={label}"))
        .option("checkpointLocation", checkpoint)
    )


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options: one fixed topic, or per-row topics when none is given; idempotent, all replicas."""
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }
    if topic:
        options["topic"] = topic
    return options


def sink_kafka(stream: DataFrame, value: Column, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Values to one topic (needs the connector on the class path)."""
    return (
        stream.select(value.cast("string").alias("value")).writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic)).option("checkpointLocation", checkpoint)
    )


def routed(df: DataFrame, topic: Column, value: Column, key: Column | None = None) -> DataFrame:
    """Rows with a topic of their own: ``topic``, ``key``, ``value``."""
    key = F.lit(None) if key is None else key
    return df.select(topic.alias("topic"), key.cast("string").alias("key"), value.cast("string").alias("value"))


def sink_routed(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """``topic, key, value`` rows to the broker (needs the connector on the class path)."""
    return (
        messages.writeStream.format("kafka").options(**kafka_sink_options(servers))
        .option("checkpointLocation", checkpoint)
    )


def sink_routed_files(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """``topic, key, value`` rows to one folder per topic, in one pass."""
    return (
        messages.writeStream.format("parquet").partitionBy("topic")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def click_rows(clicks: DataFrame) -> DataFrame:
    """Columns of the ``clicks`` table: the number column holds the event time."""
    return clicks.select("user", "url", F.col("timestamp").alias("num"))


def jdbc_sink_options(url: str, table: str, user: str, password: str, driver: str, batch_size: int = 1000) -> dict[str, str]:
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "batchsize": str(batch_size),
    }


def sink_jdbc(stream: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Append each micro-batch with batched inserts (needs the database driver on the class path)."""
    def append(batch: DataFrame, _batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).mode("append").save()

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


class ConnectionWriter:
    """One connection per task and micro-batch: opened once, used per row, closed at the end.

    ``insert`` gets the connection, the row, the partition and the epoch, so it can skip rows of an
    epoch it has stored before.
    """

    def __init__(
        self, connect: Callable[[], object], insert: Callable[[object, Row, int, int], None], disconnect: Callable[[object], None],
    ):
        self._connect, self._insert, self._disconnect = connect, insert, disconnect
        self._connection = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._where = (partition_id, epoch_id)
        self._connection = self._connect()
        return True

    def process(self, row: Row) -> None:
        self._insert(self._connection, row, *self._where)

    def close(self, error: Exception | None) -> None:
        if self._connection is not None:
            self._disconnect(self._connection)


def sink_partition_conn(stream: DataFrame, writer: ConnectionWriter, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.foreach(writer).option("checkpointLocation", checkpoint)


def bucketed_lines(lines: DataFrame, at: Column) -> DataFrame:
    """``value`` rows with the hour folder ``yyyy-MM-dd HH`` they belong to."""
    return lines.select(F.date_format(at, "yyyy-MM-dd HH").alias("dt_hour"), "value")


def sink_rolling_files(
    lines: DataFrame, path: str, checkpoint: str, at: Column | None = None, every: str = "10 seconds", rows_per_file: int = 50_000,
) -> DataStreamWriter:
    """UTF-8 text files in hour folders; a new file per trigger and per ``rows_per_file`` rows."""
    at = F.current_timestamp() if at is None else at
    return (
        bucketed_lines(lines, at).writeStream.format("text").partitionBy("dt_hour")
        .option("maxRecordsPerFile", rows_per_file)
        .option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    )


def sink_dimensions(keyed: DataFrame, path: str, checkpoint: str, seq: str = "seq", fold_every: int = 50) -> DataStreamWriter:
    """Latest ``value`` per ``key`` of each micro-batch, appended; the snapshot is the latest over batches.

    Work per batch is the batch alone, and a replayed batch replaces itself. Every ``fold_every`` batches the history is folded into one
    snapshot, so a reader meets one snapshot and fewer than twice ``fold_every`` batch folders however long the sink runs.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        newest = first_per_key(batch, ["key"], [F.col(seq).desc()])
        write_batches(newest.select("key", "value", F.col(seq).alias("seq")), batch_id, path)
        if batch_id % fold_every == fold_every - 1:
            fold_dimensions(batch.sparkSession, path, batch_id)

    return keyed.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)


def fold_dimensions(spark: SparkSession, path: str, batch_id: int) -> None:
    """Fold all batches up to ``batch_id`` and the snapshot before them into the snapshot of ``batch_id``.

    A snapshot counts once its write has ended, and is made from an earlier one, so a replay makes it again. What the snapshot before it covers is
    removed; a reader that started with that one loses nothing until the next fold.
    """
    before, rows = _since_fold(spark, path, batch_id)
    newest = first_per_key(rows.where(F.col("batch_id") <= batch_id), ["key"], [F.col("seq").desc(), F.col("batch_id").desc()])
    newest.write.mode("overwrite").parquet(f"{path}{FOLDED}/upto={batch_id}")
    if before is None:
        return
    old = [f"{path}{FOLDED}/upto={n}" for n in finished(spark, f"{path}{FOLDED}", "upto") if n < before]
    old += [f"{path}/batch_id={n}" for n in finished(spark, path, "batch_id") if n <= before]
    for folder in old:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_dimensions(spark: SparkSession, path: str) -> DataFrame:
    """Current snapshot of a dimension folder."""
    return _newest_dimensions(spark, path).select("key", "value")


def compact_dimensions(spark: SparkSession, path: str, target: str) -> None:
    """Write the snapshot of ``path`` as the first folder of ``target``; a restarted sink goes on from there."""
    write_batches(_newest_dimensions(spark, path).drop("batch_id"), -1, target)


#: Snapshots lie beside the folder of the batches, under its name and this.
FOLDED = "-folded"


def _since_fold(spark: SparkSession, path: str, before: int | None = None) -> tuple[int | None, DataFrame]:
    """The batch the newest snapshot goes up to (of those before ``before``), and its rows with those of later batches."""
    schema = "key string, value string, seq bigint, batch_id bigint"
    rows = spark.read.schema(schema).parquet(path)
    upto = max((n for n in finished(spark, f"{path}{FOLDED}", "upto") if before is None or n < before), default=None)
    if upto is None:
        return None, rows
    return upto, spark.read.schema(schema).parquet(f"{path}{FOLDED}/upto={upto}").unionByName(rows.where(F.col("batch_id") > upto))


def _newest_dimensions(spark: SparkSession, path: str) -> DataFrame:
    return first_per_key(_since_fold(spark, path)[1], ["key"], [F.col("seq").desc(), F.col("batch_id").desc()])
