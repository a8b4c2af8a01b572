"""Reference tables with versions: each micro-batch keeps the version it first met."""

import pytest
from pyspark.sql import functions as F

from streamloom.session import scratch
from streamloom.streaming.run import read_batches
from streamloom.streaming.versions import VersionedTable, start_versioned


def names(df):
    return sorted(r.name for r in df.collect())


def test_snapshots_are_whole(spark):
    table = VersionedTable(spark, scratch(spark, "lists"), "name string")
    assert table.newest() == -1 and names(table.at(-1)) == []
    spark.createDataFrame([("a",)], "name string").write.parquet(f"{table.path}/started")
    assert table.publish(spark.createDataFrame([("a",)], "name string")) == 0
    assert table.publish(spark.createDataFrame([("a",), ("b",)], "name string")) == 1
    table.at(0).limit(0).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/version=2")
    assert table.newest() == 1 and names(table.at(1)) == ["a", "b"] and names(table.at(0)) == ["a"]


def test_a_batch_that_is_run_again_meets_its_own_version(spark):
    lists = VersionedTable(spark, scratch(spark, "lists"), "name string")
    lists.publish(spark.createDataFrame([("a",)], "name string"))
    feed, path, checkpoint = scratch(spark, "feed"), scratch(spark, "out"), scratch(spark, "checkpoint")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int")
    rows.write.parquet(feed)
    failures = [1]

    def work(batch, listed):
        if failures:  # after the version was bound, before anything is written
            failures.pop()
            lists.publish(spark.createDataFrame([("a",), ("b",)], "name string"))
            raise RuntimeError("lost")
        return batch.join(listed, "name", "left_semi")

    stream = spark.readStream.schema(rows.schema).parquet(feed)
    with pytest.raises(Exception, match="lost"):
        start_versioned(stream, path, checkpoint, reference=lists, work=work).awaitTermination()
    start_versioned(stream, path, checkpoint, reference=lists, work=work).awaitTermination()
    rows.withColumn("n", F.col("n") + 10).write.mode("append").parquet(feed)
    start_versioned(stream, path, checkpoint, reference=lists, work=work).awaitTermination()
    assert sorted(tuple(r) for r in read_batches(spark, path, rows.schema).collect()) == [("a", 1, 0), ("a", 11, 1), ("b", 12, 1)]
