"""Streaming forms: known answers, late data per event, timers, sinks and restart."""

import pytest
from pyspark.sql import functions as F

from fixtures import CLICKS, LATE1, LATE2, SENSORS, WORD_COUNTS, WORDS, clicks, one_file_per_row
from streamloom.operators import windows
from streamloom.plans import log_fanout
from streamloom.schemas import CLICK
from streamloom.session import scratch
from streamloom.sources.files import read_clicks, read_text
from streamloom.streaming import queries, sinks, stateful
from streamloom.streaming.lateness import LateTumblingCount
from streamloom.streaming.run import EndMark, read_batches, run_latest, run_to_table, start_to_table

FAR = ("end", "./end", 4102444800000)


def feed(spark, path, rows, per_batch=1):
    """Clicks as a stream, by default one arrival per micro-batch."""
    folder = one_file_per_row(path, rows)
    lines = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", per_batch).csv(folder)
    return lines.withColumn("ts", F.timestamp_millis("timestamp"))


def finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_running_word_count_reports_every_update(spark, tmp_path, rows):
    folder = tmp_path / "words"
    folder.mkdir()
    for i, line in enumerate(WORDS[2:]):
        (folder / f"{i}.txt").write_text(line + "\n")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
    updates = run_to_table(queries.word_count(stream), "update")
    assert [n for (n,) in rows(updates.filter("word = 'hello'"), "n")] == [1, 2, 3]
    (tmp_path / "all").mkdir()
    (tmp_path / "all" / "words").write_text("\n".join(WORDS))
    final = run_latest(queries.word_count(read_text(spark, str(tmp_path / "all"), streaming=True)), ["word"])
    assert {r["word"]: r["n"] for r in final.collect()} == WORD_COUNTS


@pytest.mark.parametrize("make", [
    lambda df: windows.tumble_count(df, ["url"], 5000),
    lambda df: windows.slide_count_stream(df, ["url"], 10_000, 5000),
    lambda df: windows.session_count_stream(df, ["user"], 2000),
])
def test_streams_equal_batch(spark, tmp_path, rows, make):
    end = EndMark(spark)
    stream = end.on(feed(spark, tmp_path / "in", CLICKS), "ts").withWatermark("ts", "2 seconds")  # a file per micro-batch
    got = run_to_table(make(stream), end=end).drop("batch_id")
    assert rows(got, *sorted(got.columns)) == rows(make(clicks(spark, CLICKS)), *sorted(got.columns))


def test_processing_time_windows_run(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", CLICKS[:3]).withColumn("one", F.lit(1))
    out = run_latest(windows.tumble_sum_arrival(stream, ["user"], "one", 3_600_000 * 24), ["user", "win_start"])
    assert out.agg(F.sum("one")).first()[0] == 3


def test_distinct_users_of_a_stream(spark, tmp_path, rows):
    end = EndMark(spark)
    stream = end.on(feed(spark, tmp_path / "in", CLICKS, 100), "ts").withWatermark("ts", "2 seconds")
    assert rows(run_to_table(windows.window_uv_stream(stream, "user", 5000), end=end), "win_start", "uv") == [(0, 3), (5000, 2)]


def test_top_two_of_closing_windows(spark, tmp_path, rows):
    end = EndMark(spark)
    stream = end.on(feed(spark, tmp_path / "in", CLICKS, 100), "ts")
    path, checkpoint = scratch(spark, "top"), scratch(spark, "top-checkpoint")
    end.run(lambda: queries.start_topn(stream, 10_000, 5000, 2, "2 seconds", path, checkpoint))
    got = spark.read.schema("win_start bigint, win_end bigint, url string, count bigint, rank int").parquet(path)
    assert rows(got, "win_start", "rank", "url", "count") == sorted(
        [(-5000, 1, "./cart", 2), (-5000, 2, "./home", 1), (0, 1, "./home", 4), (0, 2, "./cart", 3), (5000, 1, "./home", 3),
         (5000, 2, "./cart", 1)], key=repr)


def test_spark_itself_drops_late_rows(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", LATE1).withWatermark("ts", "2 seconds")
    counted = run_latest(windows.tumble_count(stream, ["url"], 3000), ["win_start"])
    assert rows(counted, "win_start", "count") == [(6000, 3), (9000, 1)]


def run_late(spark, path, data, size, delay, lateness):
    job = LateTumblingCount(scratch(spark, "late"), size, delay, lateness)
    finish(job.writer(feed(spark, path, data), scratch(spark, "late-checkpoint")))
    emitted = job.emitted(spark, flush_after=len(data) - 1).orderBy("batch_id", "win_start")
    return [(r["win_start"], r["count"], r["kind"]) for r in emitted.collect()], sorted(
        r["timestamp"] for r in job.later(spark).collect())


def test_late_rows_go_to_the_side(spark, tmp_path):
    emitted, later = run_late(spark, tmp_path / "in", LATE1, 3000, 2000, 0)
    assert emitted == [(6000, 3, "first"), (9000, 1, "first")]
    assert later == [1000, 2000, 3000, 4000, 5000]


def test_late_rows_fire_again_in_order(spark, tmp_path):
    emitted, later = run_late(spark, tmp_path / "in", LATE2, 2000, 4000, 6000)
    base = 1684768300000
    assert [(s - base, c) for s, c, _ in emitted] == [(18000, 1), (18000, 2), (16000, 1), (20000, 2), (22000, 2), (24000, 1)]
    assert later == []


def test_a_replayed_batch_changes_nothing(spark):
    job = LateTumblingCount(scratch(spark, "late"), 3000, 2000, 0)
    parts = [clicks(spark, LATE1[:5]), clicks(spark, LATE1[5:])]
    for batch_id, part in enumerate(parts):
        job.process(part, batch_id)
    before = sorted(map(tuple, job.emitted(spark, 1).collect())), job.later(spark).count()
    job.process(parts[1], 1)
    assert (sorted(map(tuple, job.emitted(spark, 1).collect())), job.later(spark).count()) == before


def test_event_timers(spark, tmp_path, rows):
    data = [("Bob", "./a", 4000), ("Bob", "./b", 15000), FAR, FAR]
    out = run_to_table(stateful.timer_event(feed(spark, tmp_path / "in", data), 10_000, "2 seconds"))
    assert rows(out.filter("user = 'Bob'"), "at", "kind") == [(14000, "timer"), (15000, "arrival"), (25000, "timer"), (4000, "arrival")]


def test_processing_timers(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [("Bob", "./a", 1)])
    path = scratch(spark, "clock")
    out = stateful.timer_processing(stream, 1000)
    run = start_to_table(out, path, scratch(spark, "clock-checkpoint"), processingTime="1 second")
    try:
        seen = []
        for _ in range(20):
            run.awaitTermination(2)
            if run.recentProgress:
                seen = read_batches(spark, path, out.schema).collect()
            if any(r["kind"] == "timer" for r in seen):
                break
    finally:
        run.stop()
    by_kind = {r["kind"]: r["at"] for r in seen}
    assert by_kind["timer"] == by_kind["arrival"] + 1000


def test_streaming_count_window(spark, tmp_path, rows):
    folder = one_file_per_row(tmp_path / "in", [("k", i) for i in range(1, 13)])
    stream = spark.readStream.schema("key string, value bigint").option("maxFilesPerTrigger", 4).csv(folder).coalesce(1)
    got = rows(run_to_table(stateful.count_window(stream, 10, 5)), "fire", "rows")
    assert got == [(1, 5), (2, 10)]


def test_union_follows_the_slower_watermark(spark, tmp_path, rows):
    first = feed(spark, tmp_path / "a", [("a", "x", 1000), ("a", "x", 60_000), ("a", "x", 61_000)])
    second = feed(spark, tmp_path / "b", [("b", "x", 1000), ("b", "x", 2000), ("b", "x", 3000)])
    both = queries.union_watermarked(first, "2 seconds", second, "5 seconds")
    assert run_to_table(windows.tumble_count(both, ["url"], 5000)).count() == 0


def test_stream_joins(spark, tmp_path, rows):
    def side(name, data, schema):
        folder = one_file_per_row(tmp_path / name, data)
        return spark.readStream.schema(schema).csv(folder)

    far = "2100-01-01 00:00:00"
    headers = side("h", [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:10"), (-1, far)], "hid int, h_ts timestamp")
    details = side("d", [(1, "2024-01-01 00:00:05"), (3, "2024-01-01 00:00:06"), (1, "2024-01-01 00:00:07"), (-2, far)], "did int, d_ts timestamp")

    def joined(how):
        out = run_to_table(queries.keyed_join(headers, details.withColumnRenamed("did", "hid2").withColumnRenamed("hid2", "hid"), "hid", "h_ts", "d_ts", "1 second", "1 minute", how))
        return rows(out.filter("coalesce(__key, hid) > 0"), "__key", "hid")

    assert joined("inner") == [(1, 1), (1, 1)]
    assert joined("full_outer") == sorted([(1, 1), (1, 1), (2, None), (None, 3)], key=repr)


def test_restart_resumes_without_loss_or_repeat(spark, tmp_path, rows):
    folder, path, checkpoint = tmp_path / "in", scratch(spark, "resume"), scratch(spark, "resume-checkpoint")
    folder_name = one_file_per_row(folder, CLICKS[:4])

    def run():
        stream = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1).csv(folder_name)
        start_to_table(stream, path, checkpoint).awaitTermination()

    run()
    for i, row in enumerate(CLICKS[4:]):
        (folder / f"more-{i}.csv").write_text(",".join(map(str, row)) + "\n")
    run()
    run()
    assert rows(read_batches(spark, path, CLICK), "user", "url", "timestamp") == sorted(CLICKS, key=repr)


def test_a_failed_batch_is_replayed_once(spark, tmp_path, rows):
    folder = one_file_per_row(tmp_path / "in", CLICKS[:3])
    path, checkpoint, failed = scratch(spark, "replay"), scratch(spark, "replay-checkpoint"), []

    def flaky(batch):
        if batch.first()["timestamp"] == 2000 and not failed:
            failed.append(1)
            raise RuntimeError("lost")
        return batch

    def run():
        stream = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1).csv(folder)
        start_to_table(stream, path, checkpoint, finish=flaky).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert rows(read_batches(spark, path, CLICK), "timestamp") == [(1000,), (2000,), (3000,)]


def test_labelled_and_rolling_sinks(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", CLICKS[:2])
    path = scratch(spark, "label")
    finish(sinks.sink_labelled(stream.select("user"), "first", path, scratch(spark, "c")))
    assert rows(spark.read.parquet(path), "label", "value") == [("first", '{"user":"Alice"}'), ("first", '{"user":"Mary"}')]
    path = scratch(spark, "rolling")
    lines = feed(spark, tmp_path / "in", CLICKS[:2]).select(F.col("user").alias("value"), "ts")
    finish(sinks.sink_rolling_files(lines, path, scratch(spark, "c"), at=F.col("ts")))
    assert rows(spark.read.schema("value string, dt_hour string").text(path)) == [("Alice", "1970-01-01 00"), ("Mary", "1970-01-01 00")]


def test_routed_sink(spark, tmp_path, rows):
    stream = feed(spark, tmp_path / "in", CLICKS[:3])
    path = scratch(spark, "routed")
    finish(sinks.sink_routed_files(sinks.routed(stream, F.col("user"), F.col("url"), F.col("timestamp")), path, scratch(spark, "c")))
    assert rows(spark.read.parquet(path), "topic", "key", "value") == [
        ("Alice", "2000", "./cart"), ("Bob", "3000", "./prod?id=100"), ("Mary", "1000", "./home")]


def test_sink_options():
    assert sinks.kafka_sink_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "kafka.acks": "all", "kafka.enable.idempotence": "true", "topic": "t"}
    assert "topic" not in sinks.kafka_sink_options("h:1")
    assert sinks.jdbc_sink_options("u", "clicks", "a", "b", "d")["dbtable"] == "clicks"


def test_click_rows(spark, rows):
    assert rows(sinks.click_rows(clicks(spark, CLICKS[:1]))) == [("Mary", "./home", 1000)]


def test_one_connection_per_task(spark, tmp_path):
    log = str(tmp_path / "log")

    def write(text):
        with open(log, "a") as out:
            out.write(text + "\n")

    writer = sinks.ConnectionWriter(
        lambda: write("open") or "connection", lambda _c, row, _p, _e: write(row["user"]), lambda _c: write("close"))
    finish(sinks.sink_partition_conn(feed(spark, tmp_path / "in", CLICKS[:2]), writer, scratch(spark, "c")))
    lines = open(log).read().split()
    assert lines.count("open") == lines.count("close") >= 2 and {"Mary", "Alice"} < set(lines)


def test_dimensions_keep_the_latest(spark, tmp_path, rows):
    folder = one_file_per_row(tmp_path / "in", [("k1", "a", 1), ("k2", "x", 1), ("k1", "b", 2), ("k1", "c", 3)])
    stream = spark.readStream.schema("key string, value string, seq bigint").option("maxFilesPerTrigger", 2).csv(folder)
    path = scratch(spark, "dims")
    finish(sinks.sink_dimensions(stream, path, scratch(spark, "c")))
    assert rows(sinks.read_dimensions(spark, path)) == [("k1", "c"), ("k2", "x")]


LOGS = [
    '{"common":{"mid":"m1","uid":"1","ar":"2","ch":"c","os":"o","md":"d","vc":"v","is_new":"1"},"page":{"page_id":"p","during_time":5},'
    '"displays":[{"display_type":"a","order":"1"}],"ts":10}',
    '{"common":{"mid":"m1"},"page":{"page_id":"q","last_page_id":"p"},"actions":[{"action_id":"x","ts":11},{"action_id":"y","ts":12}],'
    '"displays":[{"display_type":"a"}],"start":{"entry":"icon","loading_time_ms":7},"ts":20}',
    '{"common":{"mid":"m2"},"start":{"entry":"notice"},"ts":30}',
    '{"common":{"mid":"m2"},"page":{"page_id":"z"},"err":{"code":7,"inner":{"a":[1,2]}},"ts":40}',
]


def test_log_rules(spark, tmp_path, rows):
    raw = spark.createDataFrame([(x,) for x in LOGS], "value string")
    logs = log_fanout.parse_logs(raw)
    assert rows(log_fanout.log_error(logs)) == [('{"code":7,"inner":{"a":[1,2]}}',)]
    assert rows(log_fanout.log_page(logs), "page_id", "last_page_id", "ts") == [("p", None, 10), ("q", "p", 20)]
    assert rows(log_fanout.log_action(logs), "action_id", "ts") == [("x", 11), ("y", 12)]
    assert rows(log_fanout.log_display(logs), "page_id", "ts") == [("q", 20)]
    assert rows(log_fanout.log_display_all(logs), "page_id", "ts") == [("p", 10), ("q", 20)]
    assert rows(log_fanout.log_start(logs), "mid", "entry", "ts") == [("m1", "icon", 20), ("m2", "notice", 30)]
    counts = {r["topic"]: r["count"] for r in log_fanout.route_logs(raw).groupBy("topic").count().collect()}
    assert counts == {log_fanout.TOPICS[k]: n for k, n in {"error": 1, "page": 2, "action": 2, "display": 1, "start": 2}.items()}
    values = [r["value"] for r in log_fanout.route_logs(raw).collect()]
    assert '{"mid":"m2","entry":"notice","ts":30}' in values


@pytest.mark.parametrize("files", [1, 3])
def test_tables_of_one_or_several_files_stream(spark, tmp_path, sf, files):
    from streamloom.sources.files import read_table, stream_table

    read_table(spark, sf, "events").repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (str(tmp_path), sf):
        rows = run_to_table(stream_table(spark, folder, "events", files_per_batch=1))
        assert rows.count() == read_table(spark, sf, "events").count()
    with pytest.raises(Exception, match="nowhere"):
        stream_table(spark, str(tmp_path), "nowhere")


def test_first_visit_of_a_disordered_stream(spark, tmp_path):
    """Several files, late rows in later ones: the earliest row per device and day, and all of it."""
    from streamloom.plans.dau import first_visits_stream

    day = 86_400_000
    rows = [("m1", None, 5000, "c"), ("m1", None, 9000, "d"), ("m2", "home", 10, "x"), ("m2", None, day + 7, "e"), ("m1", None, 1000, "a"), ("m1", None, 1000, "b"), ("m1", None, day + 1, "f")]
    schema = "mid string, last_page_id string, ts long, page_id string"
    for i, row in enumerate(rows):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    end = EndMark(spark)
    stream = end.on(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "ts")
    got = run_to_table(first_visits_stream(stream, "2 days"), end=end).filter("mid IS NOT NULL")
    assert sorted((r.mid, r.ts, r.page_id) for r in got.collect()) == [("m1", 1000, "a"), ("m1", day + 1, "f"), ("m2", day + 7, "e")]
