"""Streams with keyed state over several micro-batches and restarts: known answers, and equality with the batch form."""

import random

from pyspark.sql import functions as F

from fixtures import LATE1, LATE2, clicks
from streamloom.operators import windows
from streamloom.plans.dau import first_visits_stream
from streamloom.streaming import keyed_state, stateful
from streamloom.streaming.run import EndMark, feed_in_order, read_batches, start_to_table, written_schema

END = 221845392000000


def late(spark, data, size, delay, lateness):
    """Emissions with one arrival per micro-batch."""
    rows = [(user, url, at, i) for i, (user, url, at) in enumerate(data)]
    df = spark.createDataFrame(rows, "user string, url string, timestamp bigint, seq bigint").withColumn("ts", F.timestamp_millis("timestamp"))
    mark = {"ts": EndMark.AT, "timestamp": END, "url": "end", "seq": 0}
    out = feed_in_order(spark, [(df, "seq")], len(rows), lambda s: keyed_state.late_counts(s, size, delay, lateness), marks=[mark])
    return out.filter(F.col("win_end") < END).orderBy("batch_id", "win_start", "seq").collect()


def test_late_rows_go_to_the_side_and_fire_once(spark):
    out = late(spark, LATE1, 3000, 2000, 0)
    assert [(r.win_start, r["count"]) for r in out if r.kind == "first"] == [(6000, 3), (9000, 1)]
    assert [r.timestamp for r in out if r.kind == "later"] == [5000, 4000, 3000, 2000, 1000]


def test_late_rows_fire_again_at_once(spark):
    base = 1684768300000
    out = late(spark, LATE2, 2000, 4000, 6000)
    assert [(r.win_start - base, r["count"]) for r in out] == [(18000, 1), (18000, 2), (16000, 1), (20000, 2), (22000, 2), (24000, 1)]
    assert [r.kind for r in out] == ["refire"] * 3 + ["first"] * 3


def test_running_results_per_record_survive_restarts(spark):
    random.seed(2)
    data = [("hot" if random.random() < 0.5 else f"k{i % 5}", i * 7, random.choice([None, *range(-9, 9)]), f"o{i}") for i in range(300)]
    df = spark.createDataFrame(random.sample(data, 300), "id string, seq bigint, vc int, other string")
    out = feed_in_order(spark, [(df, "seq")], 3, lambda s: keyed_state.running_changelog(s, "id", "vc", "other"))
    got = {r.seq: r for r in out.collect()}
    assert len(got) == out.count() == 300 and len({r.batch_id for r in got.values()}) == 3
    seen = {}
    for key, seq, vc, other in data:
        own = seen.setdefault(key, [other, []])
        own[1].append(vc)
        values = [v for v in own[1] if v is not None]
        want = (own[0], other, len(own[1]), sum(values) if values else None, max(values, default=None))
        r = got[seq]
        assert (r.first_other, r.other, r.n, r.total, r.largest) == want


def test_connected_sides_meet_across_batches(spark):
    random.seed(3)
    left = [(random.randint(0, 9), t, f"l{t}") for t in range(0, 120, 2)] + [(None, 3, "lost")]
    right = [(random.randint(0, 9), random.randint(0, 119), f"r{i}") for i in range(60)]
    a = spark.createDataFrame(left, "id bigint, at bigint, a string")
    b = spark.createDataFrame(right, "id bigint, at bigint, b string")
    out = feed_in_order(spark, [(a, "at"), (b, "at")], 3, lambda x, y: keyed_state.connect_by_key(x, y, "id", "at", "at"))
    got = sorted((r.id, r.l.a, r.r.b, r.later_side) for r in out.select("id", "later_side", F.from_json("left", "a string").alias("l"), F.from_json("right", "b string").alias("r")).collect())
    assert got == sorted((i, x, y, "left" if t > u else "right") for i, t, x in left for j, u, y in right if i == j)


def test_a_day_of_first_visits_is_never_lost(spark):
    """1,200 days, rows written in no order of time: the stream gets them in order and keeps what the batch form keeps."""
    random.seed(4)
    day = 86_400_000
    data = [(f"m{random.randint(0, 3)}", None, random.randrange(1, 1200 * day), i) for i in range(1500)]
    pages = spark.createDataFrame(data, "mid string, last_page_id string, ts bigint, during_time bigint").repartition(5)
    out = feed_in_order(spark, [(pages, "ts")], 4, lambda s: first_visits_stream(s, "1 day"), marks=[{"ts": END}]).filter(F.col("ts") < END)
    want = {}
    for mid, _, ts, i in data:
        want[mid, ts // day] = min(want.get((mid, ts // day), (ts, i)), (ts, i))
    assert sorted((r.mid, r.ts, r.during_time) for r in out.collect()) == sorted((mid, ts, i) for (mid, _), (ts, i) in want.items())


def test_exact_users_of_closing_windows(spark):
    data = [(f"u{i % 7}" if i % 11 else None, "x", i * 100) for i in range(300)]
    out = feed_in_order(spark, [(clicks(spark, data), "timestamp")], 3, lambda s: windows.window_uv_exact_stream(s.withWatermark("ts", "1 second"), "user", 5000), marks=[{"ts": EndMark.AT}])
    want = {w: len({u for u, _, t in data if t // 5000 * 5000 == w and u}) for w in range(0, 30_000, 5000)}
    assert {r.win_start: r.uv for r in out.collect()} == want


def test_a_join_without_a_bound_runs_without_python(spark):
    """Rows of both sides stay in the state of Spark's own join; a key of NULL and a number of NULL are no error."""
    a = spark.createDataFrame([(1, 5, "x"), (1, None, "y"), (None, 2, "z")], "id bigint, at bigint, a string")
    b = spark.createDataFrame([(1, 5, "p"), (1, 1, "q"), (2, 3, "r")], "id bigint, at bigint, b string")
    plans = []

    def make(x, y):
        plans.append(keyed_state.connect_by_key(x, y, "id", "at", "at"))
        return plans[0]

    out = feed_in_order(spark, [(a, "at"), (b, "at")], 2, make)
    assert "TransformWithState" not in plans[0]._jdf.queryExecution().logical().toString()
    got = sorted((r.id, r.l.a, r.r.b, r.later_side) for r in out.select("id", "later_side", F.from_json("left", "a string").alias("l"), F.from_json("right", "b string").alias("r")).collect())
    assert got == [(1, "x", "p", "right"), (1, "x", "q", "left"), (1, "y", "p", "right"), (1, "y", "q", "right")]


def test_a_join_without_a_bound_keeps_its_rows_as_tables(spark, tmp_path):
    """No row is looked up in a state store: a micro-batch joins its rows with the tables of those before, and one that is run again replaces itself."""
    a = spark.createDataFrame([(i % 5, i, f"l{i}") for i in range(0, 90, 2)], "id bigint, at bigint, a string")
    b = spark.createDataFrame([(i % 7, i, f"r{i}") for i in range(1, 90, 2)] + [(1, 2, "r2"), (1, 2, "r2")], "id bigint, at bigint, b string")
    want = sorted((i, x, y, "left" if t > u else "right") for i, t, x in a.collect() for j, u, y in b.collect() if i == j)
    folders, path, checkpoint = [str(tmp_path / n) for n in ("a", "b")], str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for df, folder in zip((a, b), folders):
        df.limit(0).write.parquet(folder)
    stream = keyed_state.connect_by_key(*[spark.readStream.schema(df.schema).parquet(folder) for df, folder in zip((a, b), folders)], "id", "at", "at")
    assert "Join" not in stream._jdf.queryExecution().logical().toString()

    def pairs():
        out = read_batches(spark, path, written_schema(stream))
        return sorted((r.id, r.l.a, r.r.b, r.later_side) for r in out.select("id", "later_side", F.from_json("left", "a string").alias("l"), F.from_json("right", "b string").alias("r")).collect())

    for part in range(3):
        for df, folder in zip((a, b), folders):
            df.where(F.col("at") * 3 / 90 >= part).where(F.col("at") * 3 / 90 < part + 1).write.mode("append").parquet(folder)
        start_to_table(stream, path, checkpoint).awaitTermination()
    assert pairs() == want and not (tmp_path / "checkpoint" / "state").exists()
    (tmp_path / "checkpoint" / "commits" / "2").unlink()  # as if the driver had gone before the batch was committed
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    start_to_table(stream, path, checkpoint).awaitTermination()
    assert pairs() == want


def test_many_arrivals_of_a_user_hold_one_timer(spark, monkeypatch):
    """Due times in several lists fire each once, in later micro-batches too; the store has one timer for them."""
    monkeypatch.setattr(stateful.EventTimers, "BLOCK", 16)
    data = [("a" if i % 3 else "b", "x", 1000 + i // 2 * 100) for i in range(300)]
    rows = clicks(spark, data)
    out = feed_in_order(spark, [(rows, "timestamp")], 3, lambda s: stateful.timer_event(s, 2500, "1 second"), marks=[{"ts": EndMark.AT, "timestamp": END}]).filter(F.col("at") < END).collect()
    arrivals = sorted((r.user, r.at) for r in out if r.kind == "arrival")
    assert arrivals == sorted((user, at) for user, _, at in data)
    timers = [(r.user, r.at) for r in out if r.kind == "timer"]
    assert sorted(timers) == sorted({(user, at + 2500) for user, at in arrivals})
    assert len({r.batch_id for r in out if r.kind == "timer"}) > 1 and all(r.at <= r.wm for r in out if r.kind == "timer")
