"""The dimension sink folds its history: bounded folders, the same snapshot, replays and late changes included."""

import os

from streamloom.session import scratch
from streamloom.streaming import sinks
from streamloom.streaming.run import write_batches

CHANGE = "key string, value string, seq bigint"


def snapshot(spark, path):
    return {r.key: r.value for r in sinks.read_dimensions(spark, path).collect()}


def numbers(path):
    return sorted(int(name.split("=")[1]) for name in os.listdir(path) if "=" in name)


def test_folds_keep_the_latest_and_bound_the_folders(spark):
    feed, path, checkpoint = scratch(spark, "feed"), scratch(spark, "dims"), scratch(spark, "checkpoint")
    want: dict[str, tuple[int, str]] = {}
    spark.createDataFrame([], CHANGE).write.parquet(feed)
    stream = spark.readStream.schema(CHANGE).parquet(feed)
    for batch in range(7):
        rows = [(f"k{(batch * 3 + i) % 8}", f"v{batch}.{i}", 100 * batch + i) for i in range(4)] + [("late", f"old{batch}", 50 - batch), (None, f"n{batch}", batch)]
        for key, value, seq in rows:
            if key not in want or want[key][0] < seq:
                want[key] = (seq, value)
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(feed)
        sinks.sink_dimensions(stream, path, checkpoint, fold_every=2).trigger(availableNow=True).start().awaitTermination()
        assert snapshot(spark, path) == {key: value for key, (_, value) in want.items()}
    assert numbers(f"{path}-folded") == [3, 5] and numbers(path) == [4, 5, 6]


def test_a_replayed_fold_starts_from_the_snapshot_before(spark):
    path = scratch(spark, "dims")
    for batch in range(4):
        write_batches(spark.createDataFrame([("a", f"v{batch}", batch), (f"k{batch}", "x", batch)], CHANGE), batch, path)
        if batch % 2:
            sinks.fold_dimensions(spark, path, batch)
            sinks.fold_dimensions(spark, path, batch)
    assert snapshot(spark, path) == {"a": "v3", "k0": "x", "k1": "x", "k2": "x", "k3": "x"}
