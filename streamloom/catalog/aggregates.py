"""Grouped and running aggregates, count windows and user-written aggregates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from streamloom.catalog.registry import CLICKS, SENSORS, WORDS, query
from streamloom.operators import aggregate, project, running
from streamloom.operators.user_aggregate import UserAggregate, aggregate_with
from streamloom.plans.derived import clicks, sensors
from streamloom.shipping import ship_by_value
from streamloom.sources.files import read_table

ship_by_value(__name__)


@query("word_count", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def _(spark, sf):
    return aggregate.word_count(project.text_lines(read_table(spark, sf, "documents"), "text"), "line")


@query("count_all", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("orders", "lineitem", "customer", "events")))
def _(spark, sf):
    counts = [
        aggregate.count_all(read_table(spark, sf, t)).select(F.lit(t).alias("name"), "n")
        for t in ("orders", "lineitem", "customer", "events")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("group_sum_one", """
    SELECT o_custkey, o_orderstatus, CAST(sum(1) AS BIGINT) AS n FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    return aggregate.group_sum_one(read_table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query("uv_distinct", "SELECT event_type AS url, count(DISTINCT user_id) AS uv FROM events GROUP BY 1")
def _(spark, sf):
    return aggregate.uv_distinct(clicks(spark, sf), "user", "url")


@query("pv_uv_ratio", """
    SELECT event_type AS url, count(*) AS pv, count(DISTINCT user_id) AS uv,
        CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS ratio FROM events GROUP BY 1""")
def _(spark, sf):
    return aggregate.pv_uv_ratio(clicks(spark, sf), "user", "url")


@query("rows_by_key_map", f"""
    WITH {CLICKS}
    SELECT "user", arg_max(url, seq) AS url, arg_max(ts_ms, seq) AS timestamp, max(seq) AS seq FROM clicks GROUP BY 1""")
def _(spark, sf):
    return aggregate.rows_by_key(clicks(spark, sf).drop("ts"), ["user"], "seq")


# --- one updated result per record -------------------------------------------------------------

_FRAME = "ORDER BY seq ROWS UNBOUNDED PRECEDING"


@query("running_sum_pojo", f"""
    WITH {SENSORS}
    SELECT seq, id, first_value(ts) OVER w AS ts, CAST(sum(vc) OVER w AS BIGINT) AS vc
    FROM sensors WINDOW w AS (PARTITION BY id {_FRAME})""")
def _(spark, sf):
    return running.running_sum_keep_first(sensors(spark, sf), "id", "vc", ["ts"])


@query("running_max_pojo", f"""
    WITH {CLICKS}
    SELECT seq, "user", first_value(url) OVER w AS url, max(ts_ms) OVER w AS timestamp
    FROM clicks WINDOW w AS (PARTITION BY "user" {_FRAME})""")
def _(spark, sf):
    return running.running_max_keep_first(clicks(spark, sf), "user", "timestamp", ["url"])


@query("running_reduce_pair", f"""
    WITH {CLICKS}
    SELECT seq, "user", count(*) OVER (PARTITION BY "user" {_FRAME}) AS total FROM clicks""")
def _(spark, sf):
    return running.running_pair_sum(clicks(spark, sf), "user", F.lit(1))


@query("running_reduce_sensor", f"""
    WITH {SENSORS}
    SELECT seq, id, ts, CAST(sum(vc) OVER (PARTITION BY id {_FRAME}) AS BIGINT) AS vc FROM sensors""")
def _(spark, sf):
    return running.running_reduce_latest(sensors(spark, sf), "id", "vc", ["ts"])


@query("count_window", f"""
    WITH {SENSORS}, numbered AS (
        SELECT id, seq, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn,
            sum(vc) OVER w AS vc, count(*) OVER w AS n
        FROM sensors WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    SELECT id, rn // 5 AS fire, seq AS fired_at, n AS rows, CAST(vc AS BIGINT) AS vc FROM numbered WHERE rn % 5 = 0""")
def _(spark, sf):
    return running.count_window(sensors(spark, sf), "id", 10, 5, {"vc": ("sum", "vc")})


class ValueRange(UserAggregate):
    """Largest less smallest of the order keys, as a user would write it."""

    def create(self):
        return None

    def add(self, acc, rows: pd.DataFrame):
        return self.merge(acc, (int(rows["l_orderkey"].min()), int(rows["l_orderkey"].max())))

    def merge(self, a, b):
        if a is None or b is None:
            return a or b
        return min(a[0], b[0]), max(a[1], b[1])

    def result(self, acc):
        return acc[1] - acc[0]


@query("udaf_contract", """
    SELECT l_suppkey, max(l_orderkey) - min(l_orderkey) AS spread FROM lineitem GROUP BY 1""")
def _(spark, sf):
    rows = read_table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    return aggregate_with(rows, "l_suppkey", ValueRange(), "bigint", "spread")
