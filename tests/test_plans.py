"""What the plans must look like to hold on large tables."""

import pytest

from streamloom.catalog import QUERIES

# Queries that run something before their plan is known.
EAGER = {n for n in QUERIES if n.endswith("_stream")} | {
    "topn_two_stage", "sink_rolling_files", "sink_labelled", "sink_routed", "exactly_once_progress",
    "cross_batch_order_state", "list_state_timer", "scan_text", "insert_overwrite",
}


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_no_query_multiplies_its_inputs(spark, sf):
    for name in sorted(set(QUERIES) - EAGER):
        text = plan(spark, sf, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


@pytest.mark.parametrize("name", ["topn_window_all", "dedup_daily", "rows_by_key_map", "dim_upsert", "dau"])
def test_rank_filters_reach_below_the_shuffle(spark, sf, name):
    assert "WindowGroupLimit" in plan(spark, sf, name)


@pytest.mark.parametrize("name", ["log_page", "log_display", "log_start", "dedup_daily"])
def test_a_log_is_parsed_once(spark, sf, name):
    assert plan(spark, sf, name).count("from_json(") == 1


def test_running_aggregates_shuffle_rows_once(spark, sf):
    text = plan(spark, sf, "running_reduce_pair")
    assert "Join" not in text and text.count("+- Exchange hashpartitioning") == 3


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(spark, sf, "point_lookup")
    assert "PushedFilters: [IsNotNull(c_custkey), IsNotNull(c_name), EqualTo(c_custkey,7)" in text
    scan = plan(spark, sf, "uv_distinct")
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in scan


@pytest.mark.parametrize("name", ["left_join_one", "dim_lookup_user", "order_wide"])
def test_joins_sort_merge_beyond_the_broadcast_threshold(spark, sf, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, sf, name)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
