"""Running aggregates, windows, late rows and top-n: known answers and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import CLICKS, EVENTS, LATE1, LATE2, SENSORS, clicks
from streamloom.operators import lateness, ranking, running, windows
from streamloom.schemas import SENSOR
from streamloom.sources.collection import from_rows


@pytest.mark.parametrize("chunk", [None, 1, 2, 100])
def test_running_aggregates(spark, chunk):
    events = clicks(spark, EVENTS)
    got = running.running_max_keep_first(events, "user", "timestamp", ["url"], chunk=chunk).orderBy("seq").collect()
    assert [(r["url"], r["timestamp"]) for r in got if r["user"] == "Mary"] == [("./home", 1000), ("./home", 4000)]
    assert [(r["url"], r["timestamp"]) for r in got if r["user"] == "Bob"] == [
        ("./cart", 2000), ("./cart", 5000), ("./cart", 5000), ("./cart", 6000)]
    pairs = running.running_pair_sum(events, "user", F.lit(1), chunk=chunk).orderBy("seq").collect()
    assert [r["total"] for r in pairs if r["user"] == "Bob"] == [1, 2, 3, 4]
    sensors = from_rows(spark, SENSORS, SENSOR)
    kept = running.running_sum_keep_first(sensors, "id", "vc", ["ts"], chunk=chunk).orderBy("seq").collect()
    assert [(r["id"], r["ts"], r["vc"]) for r in kept] == [("s1", 1, 1), ("s1", 1, 12), ("s2", 2, 2), ("s4", 3, 3), ("s1", 1, 17)]
    latest = running.running_reduce_latest(sensors, "id", "vc", ["ts"], chunk=chunk).orderBy("seq").collect()
    assert [(r["id"], r["ts"], r["vc"]) for r in latest] == [("s1", 1, 1), ("s1", 1, 12), ("s2", 2, 2), ("s4", 3, 3), ("s1", 9, 17)]


@pytest.mark.parametrize("earlier_only", [False, True])
def test_running_against_brute_force(spark, earlier_only):
    rnd = random.Random(1)
    data = [(rnd.choice(["hot", "hot", "a", None]), rnd.choice([None, *range(20)]), i * 3) for i in range(200)]
    df = spark.createDataFrame(data, "k string, v int, seq bigint")
    kinds = ("sum", "count", "max", "min", "first")
    out = running.running(df, ["k"], "seq", {f"r_{kind}": (kind, F.col("v")) for kind in kinds}, 16, earlier_only)
    got = {r["seq"]: r for r in out.collect()}
    assert len(got) == len(data)
    for k, v, seq in data:
        seen = [x for kk, x, s in data if kk == k and (s < seq if earlier_only else s <= seq)]
        known = [x for x in seen if x is not None]
        r = got[seq]
        assert r["r_count"] == len(known)
        assert r["r_sum"] == (sum(known) if known else None)
        assert r["r_max"] == max(known, default=None) and r["r_min"] == min(known, default=None)
        assert r["r_first"] == (seen[0] if seen else None)


@pytest.mark.parametrize("numbers", [
    list(range(6000)),
    [*range(5999), 10**12],  # one number far behind all others
    [-10**12, *range(3000), *range(10**9, 10**9 + 2999)],
    [i * i * i for i in range(6000)],
])
def test_stretches_follow_the_rows_and_not_the_span(spark, monkeypatch, numbers):
    monkeypatch.setattr(running, "SMALLEST_CHUNK", 16)
    df = spark.createDataFrame([("hot", 1, n) for n in numbers], "k string, v int, seq bigint")
    cuts = running.cuts_for(df, "seq")
    sizes = [r["count"] for r in df.groupBy(cuts.start(F.col("seq"))).count().collect()]
    assert max(sizes) <= 4 * 6000 ** 0.5 and len(sizes) <= 4 * 6000 ** 0.5
    starts = [r[0] for r in df.orderBy("seq").select(cuts.start(F.col("seq"))).collect()]
    assert starts == sorted(starts)  # stretches are in the order of arrival
    got = running.running(df, ["k"], "seq", {"n": ("sum", F.col("v"))}).orderBy("seq").collect()
    assert [r["n"] for r in got] == list(range(1, 6001))


def test_stretches_of_odd_tables(spark):
    none = spark.createDataFrame([], "seq bigint")
    assert running.running(none, [], "seq", {"n": ("count", F.lit(1))}).collect() == []
    one = spark.createDataFrame([(5,), (None,)], "seq bigint")
    assert [tuple(r) for r in running.running(one, [], "seq", {"n": ("count", F.lit(1))}).collect()] == [(5, 1)]


@pytest.mark.parametrize("chunk", [3, 1000])
def test_count_window_against_brute_force(spark, rows, chunk):
    data = [("hot" if i % 3 else "cold", i, i * i % 17) for i in range(100)]
    df = spark.createDataFrame(data, "id string, seq bigint, vc bigint")
    got = rows(running.count_window(df, "id", 10, 5, {"vc": ("sum", "vc"), "top": ("max", "vc")}, chunk=chunk), "id", "fire", "fired_at", "rows", "vc", "top")
    want = []
    for key in ("hot", "cold"):
        of_key = [(seq, vc) for k, seq, vc in data if k == key]
        for fire in range(1, len(of_key) // 5 + 1):
            last = of_key[max(0, fire * 5 - 10):fire * 5]
            want.append((key, fire, last[-1][0], len(last), sum(v for _, v in last), max(v for _, v in last)))
    assert got == sorted(want, key=repr)


def test_sliding_counts_and_top_two(spark, rows):
    counts = windows.slide_count(clicks(spark, CLICKS), ["url"], 10_000, 5_000)
    top = rows(ranking.topn_per_window(counts, 2), "win_start", "rank", "url", "count")
    assert top == sorted([(-5000, 1, "./cart", 2), (-5000, 2, "./home", 1), (0, 1, "./home", 4), (0, 2, "./cart", 3),
                          (5000, 1, "./home", 3), (5000, 2, "./cart", 1)], key=repr)
    uneven = windows.slide_count(clicks(spark, CLICKS), ["url"], 10_000, 4_000)
    plain = windows.slide_count_stream(clicks(spark, CLICKS), ["url"], 10_000, 4_000)
    assert rows(uneven, "win_start", "url", "count") == rows(plain, "win_start", "url", "count")
    assert rows(counts, "win_start", "win_end", "url", "count") == rows(
        windows.slide_count_stream(clicks(spark, CLICKS), ["url"], 10_000, 5_000), "win_start", "win_end", "url", "count")
    assert ranking.topn_per_window(counts, 99).count() == counts.count()


def test_window_users(spark, rows):
    df = clicks(spark, CLICKS)
    assert rows(windows.window_pv_uv(df, "user", 5000), "win_start", "pv", "uv", "ratio") == [(0, 4, 3, 4 / 3), (5000, 5, 2, 2.5)]
    assert rows(windows.window_uv_incremental(df, "user", 5000)) == rows(windows.window_uv_full(df, "user", 5000)) == [(0, 5000, 3), (5000, 10000, 2)]


def test_sessions_touching_by_one_gap_are_one(spark, rows):
    df = clicks(spark, [("a", "x", 0), ("a", "x", 5000), ("a", "x", 10_001), ("b", "x", 3)])
    got = rows(windows.session_count(df, ["user"], 5000), "user", "count", "win_start", "win_end")
    assert got == [("a", 1, 10_001, 15_001), ("a", 2, 0, 10_000), ("b", 1, 3, 5003)]
    rnd = random.Random(2)
    many = clicks(spark, [(rnd.choice("ab"), "x", rnd.randrange(200_000)) for _ in range(120)])
    assert rows(windows.session_count(many, ["user"], 2000), "user", "count", "win_start", "win_end") == rows(
        windows.session_count_stream(many, ["user"], 2000), "user", "count", "win_start", "win_end")


def test_mean_time_is_the_mean(spark, rows):
    assert rows(windows.mean_timestamp(clicks(spark, CLICKS), ["user"], 5000), "user", "win_start", "mean_ms") == [
        ("Alice", 0, 2000), ("Bob", 0, 3500), ("Bob", 5000, 7250), ("Mary", 0, 1000), ("Mary", 5000, 6000)]


@pytest.mark.parametrize("chunk", [None, 2])
def test_late_rows_are_dropped(spark, rows, chunk):
    split = lateness.split_late(clicks(spark, LATE1), 3000, 2000, 0, chunk=chunk)
    assert rows(lateness.on_time_counts(split, ["url"]), "win_start", "count") == [(6000, 3), (9000, 1)]
    assert [t for (t,) in rows(lateness.late_side_output(split), "timestamp")] == [1000, 2000, 3000, 4000, 5000]


@pytest.mark.parametrize("chunk", [None, 2])
def test_late_rows_fire_again(spark, rows, chunk):
    split = lateness.split_late(clicks(spark, LATE2), 2000, 4000, 6000, chunk=chunk)
    base = 1684768300000
    assert sorted((s - base, c, k) for s, c, k in rows(lateness.emissions(split, ["url"], chunk=chunk), "win_start", "count", "kind")) == [
        (16000, 1, "refire"), (18000, 1, "refire"), (18000, 2, "refire"), (20000, 2, "first"), (22000, 2, "first"), (24000, 1, "first")]
    assert lateness.late_side_output(split).count() == 0


def simulate(rows, size, delay, lateness_ms):
    """Row by row: statuses."""
    seen, out = None, []
    for _, _, t in rows:
        wm = None if seen is None else seen - delay - 1
        end = t - t % size + size
        late = wm is not None and end - 1 <= wm
        out.append("late_dropped" if wm is not None and end - 1 + lateness_ms <= wm else "late_refire" if late else "on_time")
        seen = t if seen is None else max(seen, t)
    return out


def test_late_split_against_simulation(spark):
    rnd = random.Random(3)
    data = [("u", "x", i * 100 + rnd.randrange(6000)) for i in range(300)]
    split = lateness.split_late(clicks(spark, data), 1000, 1500, 2000, chunk=32).orderBy("seq").collect()
    want = simulate(data, 1000, 1500, 2000)
    assert [r["status"] for r in split] == want and len(set(want)) == 3


def test_merged_watermark_is_the_least(spark):
    data = [("a", "x", 10_000), ("b", "x", 4_000), ("a", "x", 20_000), ("b", "x", 30_000), ("a", "x", 1)]
    out = lateness.with_merged_watermark(clicks(spark, data), F.col("user"), {"a": 2000, "b": 5000}, chunk=2)
    assert [r["wm"] for r in out.orderBy("seq").collect()] == [None, None, -1001, -1001, 17_999]


def test_a_key_has_one_timer_per_time(spark, rows):
    df = clicks(spark, [("a", "x", 1), ("a", "y", 1), ("a", "x", 2)])
    assert rows(lateness.arrivals_and_timers(df, "user", 10)) == [
        ("a", 1, "arrival"), ("a", 1, "arrival"), ("a", 11, "timer"), ("a", 12, "timer"), ("a", 2, "arrival")]
