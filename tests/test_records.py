"""Record transforms, splits, unions, joins and table edits on small inputs."""

import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from fixtures import CLICKS, EVENTS, SENSORS, WORD_COUNTS, WORDS, clicks
from streamloom.operators import aggregate, joins, placement, project, split_merge, table_edits
from streamloom.operators.user_aggregate import UserAggregate, aggregate_with
from streamloom.schemas import CLASS, DAU, EMPLOYEE, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAGE_LOG, SENSOR, STUDENT, copy_same_name
from streamloom.sources import external
from streamloom.sources.collection import from_rows, numbered, numbered_stream, numbered_with_time
from streamloom.sources.files import parse_clicks, parse_sensors, read_clicks, read_text, scan_table_by_name


def test_record_widths():
    assert [len(s.fields) for s in (PAGE_LOG, DAU, ORDER_INFO, ORDER_DETAIL, ORDER_WIDE, EMPLOYEE)] == [14, 21, 22, 10, 30, 8]


def test_text_and_csv_files(spark, tmp_path, rows):
    (tmp_path / "words").write_text("\n".join(WORDS) + "\n")
    assert rows(aggregate.word_count(read_text(spark, str(tmp_path / "words")))) == sorted(WORD_COUNTS.items(), key=repr)
    (tmp_path / "clicks").write_text("\n".join(f"{u},{p},{t}" for u, p, t in CLICKS) + "\n")
    assert rows(read_clicks(spark, str(tmp_path / "clicks")), "user", "url", "timestamp") == sorted(CLICKS, key=repr)


def test_parsed_lines(spark, rows):
    lines = spark.createDataFrame([("a,./home,1000",), ("b,./cart, 2",)], "value string")
    assert rows(parse_clicks(lines)) == [("a", "./home", 1000), ("b", "./cart", 2)]
    assert rows(parse_sensors(spark.createDataFrame([("s1 7 3",)], "value string"))) == [("s1", 7, 3)]


def test_words_keep_inner_blanks_and_drop_trailing_ones(spark, rows):
    lines = spark.createDataFrame([("a  b  ",), ("",), ("   ",), (" x",)], "value string")
    got = [w for (w,) in rows(project.split_words(lines, "value"))]
    assert sorted(got) == sorted(["a", "", "b", "", "", "x"])


def test_numbered_sources(spark, rows):
    assert rows(numbered(spark, 3)) == [("a:0",), ("a:1",), ("a:2",)]
    now = F.lit("2024-04-10 15:01:00").cast("timestamp")
    assert rows(numbered_with_time(spark, 1, now)) == [("number: 0  time: 2024-04-10 15:01:00",)]
    assert numbered_stream(spark, 5).isStreaming


def test_table_name_is_checked(spark, rows):
    spark.range(2).createOrReplaceTempView("two_rows")
    assert rows(scan_table_by_name(spark, "two_rows")) == [(0,), (1,)]
    for bad in ("two_rows; drop table x", "(select 1)", "a b", ""):
        with pytest.raises(ValueError):
            scan_table_by_name(spark, bad)


def test_external_reader_options():
    options = external.kafka_options("h:9092", ["a", "b"], "g", {"a": {0: 5}})
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == '{"a": {"0": 5}}' and options["kafka.group.id"] == "g"
    assert external.kafka_options("h:9092", ["a"], start="earliest")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        external.kafka_options("h:9092", ["a"], start="yesterday")
    assert external.jdbc_options("jdbc:x", "select 1", "u", "p", "d")["query"] == "select 1"
    assert external.jdbc_partitioned_options("jdbc:x", "t", "u", "p", "d", "id", 0, 9, 3)["numPartitions"] == "3"


def test_maps_and_filters(spark, rows):
    rich = [("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Mary", "./prod?id=100", 3000),
            ("Bob", "./home", 4000), ("Bob", "./prod?id=10", 5000), ("Bob", "./cart", 6000)]
    assert [r[1] for r in rows(project.map_length(clicks(spark, rich), "url"), )] and [
        r["length"] for r in project.map_length(clicks(spark, rich), "url", "seq").orderBy("seq").collect()
    ] == [6, 6, 13, 6, 12, 6]
    sensors = from_rows(spark, [("s1", 1, 1), ("s1", 1, 11), ("s2", 2, 2), ("s3", 3, 3)], SENSOR)
    assert rows(project.flatmap_conditional(sensors, "id", "S1", "s2", "ts", "vc", "seq"), "seq", "value") == [
        (0, "1"), (1, "11"), (2, "2"), (2, "2")]
    assert rows(project.filter_ignore_case(sensors, "id", "S1"), "vc") == [(1,), (11,)]
    emitted = rows(project.process_emit(clicks(spark, CLICKS[:2]), ["Mary", "Bob"]), "value")
    assert emitted == [("Event{user='Alice', url='./cart', timestamp=2000}",),
                       ("Event{user='Mary', url='./home', timestamp=1000}",), ("Maryclick./home",)]
    assert rows(project.like_contains(sensors, "id", "_"), "vc") == [(1,), (11,), (2,), (3,)]
    assert rows(project.point_lookup(sensors, id="s1", vc=11), "ts") == [(1,)]


def test_resource_is_opened_and_closed_per_task(spark, tmp_path, rows):
    log = str(tmp_path / "log")

    def note(word):
        with open(log, "a") as out:
            out.write(word + "\n")

    def plus_one(_resource, batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(id=batch["id"] + 1)

    df = project.map_with_resource(spark.range(0, 6, 1, 2), lambda: note("open"), plus_one, lambda _r: note("close"), "id bigint")
    assert rows(df) == [(i,) for i in range(1, 7)]
    assert sorted(open(log).read().split()) == ["close"] * 2 + ["open"] * 2


def test_copy_same_name_needs_the_same_type(spark):
    out = copy_same_name(spark.createDataFrame([("m", "7")], "mid string, ts string"), PAGE_LOG).first()
    assert out["mid"] == "m" and out["ts"] is None and len(out) == 14


def test_negative_odd_numbers_are_in_neither_half(spark, rows):
    even, odd = split_merge.split_parity(spark.createDataFrame([(i,) for i in range(-3, 4)], "n int"), "n")
    assert rows(even) == [(-2,), (0,), (2,)] and rows(odd) == [(1,), (3,)]


def test_side_outputs(spark, rows):
    tagged = rows(split_merge.side_output(clicks(spark, CLICKS[:3]), ["Mary", "Bob"]))
    assert tagged == [("Bob", "./prod?id=100", "./prod?id=100", 3000), ("Mary", "./home", "./home", 1000),
                      ("else", "Alice", "./cart", 2000)]


def test_unions(spark, rows):
    a, b, c = (spark.createDataFrame([(i * k,) for i in range(1, n)], "n int") for k, n in ((1, 6), (11, 6), (10, 5)))
    assert a.unionByName(b).count() == split_merge.union_all(a, b).count() == 10
    assert rows(split_merge.union_all(a, b, c)) == rows(split_merge.union_all(split_merge.union_all(a, b), c))
    letters = spark.createDataFrame([(x,) for x in "abcde"], "s string")
    merged = split_merge.connect_map(a, F.col("n"), letters, F.col("s"))
    assert rows(merged, "value") == [(x,) for x in "12345abcde"]


def test_keyed_connect(spark, rows):
    left = spark.createDataFrame([(1, "a1", 0), (1, "a2", 2), (2, "b", 4), (3, "c", 6)], "id int, a string, l int")
    right = spark.createDataFrame([(1, "aa1", 1, 1), (1, "aa2", 2, 3), (2, "bb", 1, 5), (3, "cc", 1, 7)], "id int, b string, n int, r int")
    pairs = rows(joins.connect_keyed_join(left, right, "id", "l", "r"), "a", "b", "later_side")
    assert pairs == [("a1", "aa1", "right"), ("a1", "aa2", "right"), ("a2", "aa1", "left"), ("a2", "aa2", "right"),
                     ("b", "bb", "right"), ("c", "cc", "right")]


def test_students_and_classes(spark):
    students = spark.createDataFrame([(1, "x", 10, 1.0, 2), (2, "y", 11, 2.0, 1), (5, "z", 12, 3.0, 1)], STUDENT)
    classes = spark.createDataFrame([(1, "one"), (2, "two"), (9, "none")], CLASS)
    one = {r["sid"]: r["aClass"] for r in joins.left_join_one(students, classes, "sid", "cid", "aClass").collect()}
    assert one[1] == Row(cid=1, className="one") and one[5] is None
    many = joins.left_join_many(classes, students, "cid", "studentClass", "sid", "students").collect()
    assert {r["cid"]: [s["sid"] for s in r["students"]] for r in many} == {1: [2, 5], 2: [1], 9: []}
    sliced = joins.left_join_many(classes, students, "cid", "studentClass", "sid", "students", slice_ids=3)
    assert sorted((r["cid"], r["slice"], [s["sid"] for s in r["students"]]) for r in sliced.filter("cid = 1").collect()) == [
        (1, 0, [2]), (1, 1, [5])]
    whole = joins.left_join_list(classes, students, "cid", "studentClass", "sid", "students").collect()
    assert {r["cid"]: [s["sid"] for s in r["students"]] for r in whole} == {1: [2, 5], 2: [1], 9: []}


def test_children_without_an_id_are_spread(spark):
    child = spark.createDataFrame([(None, f"n{i}", 1) for i in range(3000)] + [(1, "x", 1), (150_000, "y", 1)], "sid int, name string, cid int")
    parent = spark.createDataFrame([(1,), (2,)], "cid int")
    got = joins.left_join_many(parent, child, "cid", "cid", "sid", "kids").collect()
    assert sum(len(r["kids"]) for r in got) == 3002 and max(len(r["kids"]) for r in got) < 30
    assert [(r["cid"], r["slice"], len(r["kids"])) for r in got if r["slice"] is None or r["slice"] >= 0] and [r["slice"] for r in got if r["cid"] == 2] == [None]


def test_full_outer_keeps_lonely_rows_of_either_side(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "id int, x string")
    right = spark.createDataFrame([(1, "p"), (3, "q"), (None, "m"), (1, "r")], "order_id int, y string")
    want = left.join(right, left["id"] == right["order_id"], "full_outer")
    assert rows(joins.full_outer_orders(left, right)) == rows(want)


def test_edits(spark, rows):
    emp = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, "c", 9.0)], "empno int, ename string, comm double")
    assert (8888, "ann", None) in rows(table_edits.insert_row(emp, empno=8888, ename="ann"))
    assert rows(table_edits.update_where(emp, F.col("comm") > 5, ename=F.lit("z")), "ename") == [("a",), ("b",), ("z",)]
    assert rows(table_edits.delete_where(emp, F.col("comm") > 5), "empno") == [(1,), (2,)]
    gone = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(table_edits.delete_in(emp, "empno", gone, "k"), "empno") == [(2,)]


def test_purchases_are_settled_together(spark, rows):
    buys = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (1, 11)], "user_id int, book_id int")
    books = spark.createDataFrame([(10, 80, 100), (11, 50, 100), (12, 5, 7)], "book_id int, price int, stock bigint")
    users = spark.createDataFrame([(1, 500), (2, 50), (3, 1)], "user_id int, balance bigint")
    stock, balance = table_edits.settle_purchases(buys, books, users)
    assert rows(stock, "book_id", "stock") == [(10, 97), (11, 99), (12, 7)]
    assert rows(balance) == [(1, 290), (2, -30), (3, 1)]


def placed(df):
    return df.withColumn("p", F.spark_partition_id()).collect()


def test_placement(spark):
    df = spark.range(0, 100, 1, 4).select("id", (F.col("id") % 10).alias("k"), F.col("id").cast("string").alias("s"))
    sizes = pd.Series([r["p"] for r in placed(placement.rebalance(df, 5))]).value_counts()
    assert len(sizes) == 5 and sizes.max() - sizes.min() <= 4
    assert placed(placement.shuffle(df, 5, ["id"])) == placed(placement.shuffle(df, 5, ["id"]))
    assert len({r["p"] for r in placed(placement.shuffle(df, 5, ["id"]))}) == 5
    assert {r["p"] for r in placed(placement.rescale(df, 2))} == {0, 1}
    assert "Exchange" not in placement.rescale(df, 2)._jdf.queryExecution().toString()
    copies = placed(placement.to_every(df, 3))
    assert len(copies) == 300 and all(r["p"] == r["target"] for r in copies)
    assert [r["id"] for r in placement.global_order(df, 3, "id").collect()] == list(range(100))
    of_key = {}
    for r in placed(placement.by_key(df, 4, "k")):
        of_key.setdefault(r["k"], set()).add(r["p"])
    assert all(len(p) == 1 for p in of_key.values())
    assert all(r["p"] == int(r["s"]) % 3 for r in placed(placement.by_parsed_modulo(df, 3, "s")))


def test_user_aggregate_merges_parts(spark, rows):
    class Mean(UserAggregate):
        def create(self):
            return (0, 0)

        def add(self, acc, batch):
            return acc[0] + int(batch["v"].sum()), acc[1] + len(batch)

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1]

        def result(self, acc):
            return acc[0] / acc[1]

    df = spark.range(0, 1000, 1, 7).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b").alias("k"), F.col("id").alias("v"))
    expected = [tuple(r) for r in df.groupBy("k").agg(F.avg("v")).collect()]
    assert rows(aggregate_with(df, "k", Mean(), "double", "mean", fan_in=3)) == sorted(expected, key=repr)
    keys = spark.createDataFrame([(9007199254740993, 1), (9007199254740992, 2), (None, 3), (None, 5)], "k bigint, v int")
    assert rows(aggregate_with(keys, "k", Mean(), "double", "mean")) == sorted([(9007199254740993, 1.0), (9007199254740992, 2.0), (None, 4.0)], key=repr)
