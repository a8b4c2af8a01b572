"""Time the headline queries: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import time

from streamloom.catalog import QUERIES
from streamloom.session import build_session

HEADLINE = [
    "word_count", "uv_distinct", "pv_uv_ratio", "group_sum_one", "rows_by_key_map",
    "running_sum_pojo", "running_max_pojo", "running_reduce_pair", "count_window",
    "tumble_count", "slide_count", "session_count", "slide_hour_30s", "window_pv_uv", "topn_window_all",
    "late_refire", "late_side_output", "connect_keyed_join", "full_outer_orders", "dim_lookup_user", "left_join_many",
    "ledger_settle_balance", "log_fanout", "log_display", "cdc_route", "dim_upsert", "dau", "order_wide",
    "calculate", "transform_digit", "extract_tables", "udaf_contract",
    "tumble_count_stream", "session_count_stream", "log_fanout_stream", "dau_stream", "order_wide_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    QUERIES["tumble_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up cost is not a query
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
