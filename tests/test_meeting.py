"""Rows that wait for a partner in another stream: what meets, what gives up and why, and what a batch join settles."""

import datetime
import random

from pyspark.sql import functions as F

from streamloom.streaming import meeting
from streamloom.streaming.meeting import LEFT_ALONE, MET, RIGHT_ALONE, SETTLED, expired_in_parts, met_in_parts

DAY0 = datetime.datetime(2024, 1, 1)
HEADER, DETAIL = "id bigint, h_at timestamp, amount int", "line int, order_id bigint, d_at timestamp"


def day(n):
    return None if n is None else DAY0 + datetime.timedelta(days=n)


def outcomes(df):
    rows = df.select(F.col("left.id").alias("id"), F.col("right.line").alias("line"), "outcome").collect()
    return sorted(((r.id, r.line, r.outcome) for r in rows), key=repr)


def test_every_row_comes_out_with_its_reason(spark):
    headers = spark.createDataFrame([(1, day(0), 5), (2, day(3), 6), (3, None, 7), (4, day(50), 8), (None, day(4), 9)], HEADER)
    details = spark.createDataFrame([
        (10, 1, day(5)), (11, 1, day(40)), (12, 2, day(1)), (13, 9, day(2)), (14, 3, day(2)), (15, 4, None), (16, None, day(4)),
    ], DETAIL)
    keys = ("id", "order_id", "h_at", "d_at", "10 days")
    waited = [(1, 10, MET), (2, 12, MET), (None, 11, RIGHT_ALONE), (None, 13, RIGHT_ALONE), (None, 14, RIGHT_ALONE), (None, 15, RIGHT_ALONE), (None, 16, RIGHT_ALONE)]
    alone = [(3, None, LEFT_ALONE), (4, None, LEFT_ALONE), (None, None, LEFT_ALONE)]
    assert outcomes(expired_in_parts(spark, headers, details, *keys)) == sorted(waited + alone, key=repr)
    settled = [(1, 10, MET), (2, 12, MET), (1, 11, SETTLED), (3, 14, SETTLED), (4, 15, SETTLED), (None, 13, RIGHT_ALONE), (None, 16, RIGHT_ALONE)]
    assert outcomes(met_in_parts(spark, headers, details, *keys)) == sorted([*settled, (None, None, LEFT_ALONE)], key=repr)


def test_pairs_at_any_distance_and_a_hot_header(spark):
    random.seed(5)
    headers = [(i, day(random.randint(0, 900)), i) for i in range(60)]
    details = [(n, 7 if n % 3 == 0 else random.randint(0, 80), day(random.randint(0, 900))) for n in range(300)]
    out = met_in_parts(
        spark, spark.createDataFrame(random.sample(headers, 60), HEADER), spark.createDataFrame(details, DETAIL), "id", "order_id", "h_at", "d_at", "30 days", parts=4)
    got = [(key, line) for key, line, _ in outcomes(out)]
    used = {order for _, order, _ in details}
    want = [(order if order < 60 else None, n) for n, order, _ in details] + [(i, None) for i in range(60) if i not in used]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_side_empty(spark):
    headers = spark.createDataFrame([(1, day(0), 5)], HEADER)
    details = spark.createDataFrame([], DETAIL)
    assert outcomes(met_in_parts(spark, headers, details, "id", "order_id", "h_at", "d_at", "10 days", parts=2)) == [(1, None, LEFT_ALONE)]
    empty = spark.createDataFrame([], HEADER)
    assert outcomes(met_in_parts(spark, empty, details, "id", "order_id", "h_at", "d_at", "10 days", parts=2)) == []


def test_waiting_rows_are_a_table_bounded_by_the_wait(spark, monkeypatch):
    """A row that has met is not alone later, and what a batch hands on is bounded by the wait, not by the rows fed so far."""
    kept, whole = [], meeting.meet_or_expire

    def counted(*args):
        out, waiting = whole(*args)
        kept.append(waiting.count())
        return out, waiting

    monkeypatch.setattr(meeting, "meet_or_expire", counted)
    headers = spark.createDataFrame([(i, day(i), i) for i in range(100)], HEADER)
    details = spark.createDataFrame([(n, n, day(n + 4)) for n in range(100) if n % 4], DETAIL)
    out = expired_in_parts(spark, headers, details, "id", "order_id", "h_at", "d_at", "5 days", parts=4)
    assert outcomes(out) == sorted([(n, n, MET) if n % 4 else (n, None, LEFT_ALONE) for n in range(100)], key=repr)
    assert len(kept) == 5 and max(kept) < 40
