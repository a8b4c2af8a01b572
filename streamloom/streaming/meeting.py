"""Rows of two streams that wait for a partner: pairs, rows that gave up waiting, and a batch join that settles those.

A row waits until the watermark is ``within`` past its time. The rows that wait are a table: a micro-batch joins its rows with those of the batch before
and writes the table of those that wait on, so the work of a batch is a few joins over its rows and the waiting ones, which Spark spills and whose hot keys
it splits, and no row costs look-ups of its own. The table is bounded by twice ``within`` and not by the history. What gives up is
emitted with its reason, never dropped, and ``settle`` finds the partners that came too far apart with one join over the rows that gave up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from streamloom.streaming.run import EndMark, feed_in_order, write_batches
from streamloom.streaming.versions import finished

MET, LEFT_ALONE, RIGHT_ALONE, SETTLED = "met", "left alone", "right alone", "settled"

#: The tables of waiting rows lie beside the folder of the outcomes, under its name and this, each with the batch it goes up to.
WAITING = "-waiting"


def sides_of(df: DataFrame, key: str, time: str) -> DataFrame:
    """``df`` as ``key``, ``at`` (timestamp) and ``row`` (the whole row), the form in which both streams come."""
    return df.select(F.col(key).alias("key"), F.col(time).cast("timestamp").alias("at"), F.struct(*df.columns).alias("row"))


def both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams in the form of ``sides_of`` as one: ``is_left``, ``key``, ``at``, ``left`` and ``right``, of which one is NULL."""
    rows = left.select(F.lit(True).alias("is_left"), "key", "at", F.col("row").alias("left"))
    return rows.unionByName(right.select(F.lit(False).alias("is_left"), "key", "at", F.col("row").alias("right")), allowMissingColumns=True)


def watermark(rows: DataFrame, delay: str) -> Column | None:
    """The smaller of both sides' largest times less ``delay``; None as long as a side has no row."""
    largest = [F.unix_micros(F.max(F.when(side, F.col("at")))) for side in (F.col("is_left"), ~F.col("is_left"))]
    known = tuple(rows.agg(*largest).first())
    return None if None in known else F.timestamp_micros(F.lit(min(known))) - F.expr(f"INTERVAL {delay}")


def meet_or_expire(waiting: DataFrame, batch: DataFrame, delay: str, within: str) -> tuple[DataFrame, DataFrame]:
    """``left``, ``right`` (rows or NULL) and ``outcome`` that a micro-batch adds, and the rows that wait after it; all rows in the form of ``both_sides``.

    Rows of one key at most ``within`` (a fixed span) apart meet, whichever micro-batches bring them. A row without a partner comes out alone, once, when the
    watermark has passed its wait; a NULL key meets nothing. ``at`` must not be NULL. Rows older than the watermark before the batch are too late and
    dropped, as by Spark's own joins of streams. A row stays in the table for twice its wait, so that those it met find it there when their own wait ends.
    """
    wait, before = F.expr(f"INTERVAL {within}"), watermark(waiting, delay)
    fresh = batch if before is None else batch.where(F.col("at") >= before)
    rows = waiting.withColumn("new", F.lit(False)).unionByName(fresh.withColumn("new", F.lit(True)))
    now = watermark(rows, delay)

    def gave_up(at: Column) -> Column:
        if now is None:
            return F.lit(False)
        return (at + wait < now) & (F.lit(True) if before is None else at + wait >= before)

    lefts = rows.where("is_left").select(F.col("key").alias("left_key"), F.col("at").alias("left_at"), F.col("new").alias("left_new"), "left")
    rights = rows.where("NOT is_left").select(F.col("key").alias("right_key"), F.col("at").alias("right_at"), F.col("new").alias("right_new"), "right")
    near = (F.col("left_key") == F.col("right_key")) & F.col("right_at").between(F.col("left_at") - wait, F.col("left_at") + wait)
    found, alone = rights.join(lefts, near, "left"), F.col("left_new").isNull()
    found = found.where((~alone & (F.col("left_new") | F.col("right_new"))) | (alone & gave_up(F.col("right_at"))))
    found = found.select("left", "right", F.when(alone, RIGHT_ALONE).otherwise(MET).alias("outcome"))
    left_alone = lefts.where(gave_up(F.col("left_at"))).join(rights.drop("right"), near, "left_anti")
    out = found.unionByName(left_alone.select("left", F.lit(LEFT_ALONE).alias("outcome")), allowMissingColumns=True)
    return out, (rows if now is None else rows.where(F.col("at") + wait + wait >= now)).drop("new")


def start_meeting(stream: DataFrame, path: str, checkpoint: str, delay: str, within: str) -> StreamingQuery:
    """Start writing the outcomes of ``both_sides`` below ``path``. A replayed batch starts from the same waiting rows and replaces itself."""
    spark = stream.sparkSession

    def meet(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}{WAITING}"
        earlier = [n for n in finished(spark, folder, "upto") if n < batch_id]
        schema = StructType([*stream.schema.fields])
        waiting = batch.sparkSession.read.schema(schema).parquet(f"{folder}/upto={earlier[-1]}") if earlier else batch.sparkSession.createDataFrame([], schema)
        out, kept = meet_or_expire(waiting, batch, delay, within)
        write_batches(out, batch_id, path)
        kept.write.mode("overwrite").parquet(f"{folder}/upto={batch_id}")
        for n in earlier[:-1]:  # a replay needs the one before only
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/upto={n}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    return stream.writeStream.foreachBatch(meet).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settle(outcomes: DataFrame, lefts: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The outcomes with every pair that the wait was too short for, as ``settled``; only rows without any partner stay alone.

    ``lefts`` is the left side as a table and its keys are unique, as an order has one header: so a right row that met nothing is all that
    can be missing from a pair, and the join takes those rows alone.
    """
    alone = outcomes.where(F.col("outcome") == RIGHT_ALONE).select("right")
    keyed = lefts.select(F.col(left_key).alias("__key"), F.struct(*lefts.columns).alias("left"))
    found = alone.join(keyed, F.col(f"right.{right_key}") == F.col("__key"), "left")
    found = found.select("left", "right", F.when(F.col("left").isNull(), RIGHT_ALONE).otherwise(SETTLED).alias("outcome"))
    keys = alone.select(F.col(f"right.{right_key}").alias("__key")).distinct()
    waiting = outcomes.where(F.col("outcome") == LEFT_ALONE).join(keys, F.col(f"left.{left_key}") == F.col("__key"), "left_anti")
    return outcomes.where(F.col("outcome") == MET).unionByName(found).unionByName(waiting)


def expired_in_parts(
    spark: SparkSession, left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str, within: str,
    parts: int = 3, delay: str = "1 day",
) -> DataFrame:
    """``meet_or_expire`` over two tables fed in the order of their times, to the end of both.

    Rows without a time cannot wait: they are alone from the start.
    """
    sides = [sides_of(df, key, time) for df, key, time in ((left, left_key, left_time), (right, right_key, right_time))]
    fed = [(side.where("at IS NOT NULL").withColumn("ms", F.unix_millis("at")), "ms") for side in sides]
    mark = {"at": EndMark.AT}
    start = lambda stream, path, checkpoint, _mode: start_meeting(stream, path, checkpoint, delay, within)
    schema = StructType([*(StructField(name, side.schema["row"].dataType) for side, name in zip(sides, ("left", "right"))), StructField("outcome", StringType())])
    out = feed_in_order(spark, fed, parts, both_sides, marks=[mark, mark], start=start, schema=schema).drop("batch_id")
    out = out.where("left IS NOT NULL OR right IS NOT NULL")  # not the marks
    for side, name, outcome in zip(sides, ("left", "right"), (LEFT_ALONE, RIGHT_ALONE)):
        untimed = side.where("at IS NULL").select(F.col("row").alias(name), F.lit(outcome).alias("outcome"))
        out = out.unionByName(untimed, allowMissingColumns=True)
    return out


def met_in_parts(spark: SparkSession, left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str, within: str, **feed) -> DataFrame:
    """``left``, ``right`` and ``outcome`` of a full outer join on the key, at any distance in time: the stream's outcomes, settled."""
    out = expired_in_parts(spark, left, right, left_key, right_key, left_time, right_time, within, **feed)
    return settle(out, left, left_key, right_key)
