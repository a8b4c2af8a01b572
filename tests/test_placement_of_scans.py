"""Scans whose splits are many and mostly empty."""

import os

from pyspark.sql import functions as F

from streamloom.operators.placement import over_all_cores


def test_one_row_group_in_many_splits_is_dealt_out(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(200_000).selectExpr("id", "cast(xxhash64(id) AS string) AS text").coalesce(1).write.parquet(path)
    size = max(os.path.getsize(f"{path}/{name}") for name in os.listdir(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 10))
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        counts = [r["count"] for r in over_all_cores(scan).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(counts) == 200_000 and max(counts) < 200_000 / 8
