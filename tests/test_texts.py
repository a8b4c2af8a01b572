"""Scalar functions on known inputs."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from streamloom.functions import clock, registry, text
from streamloom.functions.arithmetic import calculate, evaluate, number_text
from streamloom.plans.cdc import operation

NUMERALS = {"六仟零柒元整壹角肆分": "6007.14", "三百万": "300.0", "二十三": "3.0", "十元": "10.0", "": "0.0", "abc": "0.0", None: None}
SCRIPT = """drop table if exists dm_fin.dm_fin_pl_cust_f;
create table if not exists dm_fin.dm_fin_pl_cust_f
(id bigint) stored as orc;
create table if not exists dm_temp.dm_fin_pl_cust_f2 (id bigint);
create table if not exists dm_temp.dm_fin_pl_cust_f3
as select 1 as id union all select 2 as id;
insert overwrite table dm_temp.dm_fin_pl_cust_f2
select * from dm_temp.dm_fin_pl_cust_f3;
create table if not exists dm_fin.dm_fin_pl_sum_f (id bigint);
insert overwrite table dm_fin.dm_fin_pl_cust_f
select * from dm_temp.dm_fin_pl_cust_f2;
insert overwrite table dm_fin.dm_fin_pl_sum_f
select * from dm_temp.dm_fin_pl_cust_f;"""
TABLES = ["dm_fin.dm_fin_pl_cust_f", "dm_temp.dm_fin_pl_cust_f2", "dm_temp.dm_fin_pl_cust_f3", "dm_temp.dm_fin_pl_cust_f2",
          "dm_fin.dm_fin_pl_sum_f", "dm_fin.dm_fin_pl_cust_f", "dm_fin.dm_fin_pl_sum_f"]
TARGETS = ["dm_temp.dm_fin_pl_cust_f2", "dm_fin.dm_fin_pl_cust_f", "dm_fin.dm_fin_pl_sum_f"]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r["out"] for r in df.select("i", expr(F.col("c")).alias("out")).orderBy("i").collect()]


def test_numerals(spark):
    assert column(spark, NUMERALS, text.numeral_to_number) == list(NUMERALS.values())


def read_left_to_right(numeral):
    """The meaning of a numeral, character by character."""
    total = waiting = 0.0
    for char in numeral:
        if text.DIGITS.get(char):
            waiting = text.DIGITS[char]
        elif char in text.UNITS:
            total, waiting = total + waiting * text.UNITS[char], 0.0
    return total + waiting


def test_numerals_against_brute_force(spark):
    rnd = random.Random(4)
    alphabet = [*text.DIGITS, *text.UNITS, "整", "x", "\n"]
    numerals = ["".join(rnd.choices(alphabet, k=rnd.randrange(15))) for _ in range(500)]
    assert [float(x) for x in column(spark, numerals, text.numeral_to_number)] == [read_left_to_right(n) for n in numerals]


def test_scripts(spark):
    assert column(spark, [SCRIPT], text.script_tables) == [TABLES]
    assert column(spark, [SCRIPT], text.script_overwrites) == [TARGETS]


def test_sql_names(spark):
    registry.register(spark)
    spark.createDataFrame([(k,) for k in NUMERALS], "n string").createOrReplaceTempView("numerals")
    got = {r[0]: r[1] for r in spark.sql("SELECT n, transform_digit(n) FROM numerals").collect()}
    assert got == NUMERALS
    spark.createDataFrame([(SCRIPT,)], "s string").createOrReplaceTempView("scripts")
    row = spark.sql("SELECT script_tables(s) a, script_overwrites(s) b, calculate('1+2*3') c FROM scripts").first()
    assert (row["a"], row["b"], row["c"]) == (TABLES, TARGETS, "7")


def test_arithmetic(spark):
    cases = {"478*0.34738+1": 167.04764, "4.34297*349": 1515.69653, "": None, "dfsjkj": None, None: None, "-(2+3)*-4": 20.0,
             "7%4-1": 2.0, "-7%4": -3.0, "2 3": None, "(1": None, "1)": None, "1+": None, "__import__('os')": None}
    got = column(spark, cases, calculate)
    for (case, want), value in zip(cases.items(), got):
        assert (value is None) if want is None else float(value) == pytest.approx(want, rel=1e-12), case
    assert number_text(evaluate("1/0")) == "Infinity" and number_text(evaluate("0/0")) == "NaN" and number_text(evaluate("6/3")) == "2"
    texts = {"1/2000": "5.0E-4", "100000*100000": "1.0E10", "1e8*1e9": "1.0E17", "2147483648*1": "2.147483648E9", "2147483647*1": "2147483647",
             "1/8": "0.125", "-5/1000": "-0.005", "12345678.5*1": "1.23456785E7", "1234567.25*1": "1234567.25", "1/3000000": "3.3333333333333335E-7"}
    assert {t: number_text(evaluate(t)) for t in texts} == texts


def test_objects_pass_as_they_stand(spark):
    from streamloom.plans.cdc import dim_changes, dim_rows, parse_changes

    data = '{"id": 7, "a":100.10,"b" : 12345678901234567.89, "s":"x\\"}{", "o":{"data":[1.50, {"k":1e400}]}}'
    rows = [('{"old":{"data":{"z":1}}, "type":"insert","n":[1,{"data":{}}],"table":"user_info","data":%s}' % data,), ('{"type":"update","table":"user","data":{"x":1}}',), ("{broken",)]
    got = parse_changes(spark.createDataFrame(rows, "value string"))
    assert sorted(r.data for r in got.collect()) == sorted([data, '{"x":1}'])
    names = spark.createDataFrame([("user",), ("user_info",)], "name string")
    keyed = dim_changes(got, names)
    assert sorted(r.key for r in keyed.collect()) == ["DIM_USER_INFO_7", "DIM_USER_null"]
    assert [r.id for r in dim_rows(keyed, "user", {"x": "x"}, ["user", "user_info"]).collect()] == ["null"]


def test_a_long_text_is_evaluated_whole():
    assert evaluate("+".join(["1"] * 200_000)) == 200_000
    assert evaluate("(" * 5000 + "1" + ")" * 5000) == 1


expressions = st.recursive(
    st.integers(0, 99).map(str),
    lambda inner: st.one_of(
        st.tuples(inner, st.sampled_from("+-*"), inner).map(" ".join), inner.map(lambda e: f"({e})"), inner.map(lambda e: f"-({e})"),
    ), max_leaves=12,
)


@settings(max_examples=300, deadline=None)
@given(expressions)
def test_arithmetic_agrees_with_python(expression):
    assert evaluate(expression) == eval(expression)


def test_ages(spark):
    pairs = [("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("1990-05-10", "2024-05-10", 34), ("1990-05-11", "2024-05-10", 33)]
    df = spark.createDataFrame(pairs, "b string, t string, want int")
    assert all(r["want"] == r["got"] for r in df.withColumn("got", clock.age_years(F.to_date("b"), F.to_date("t"))).collect())


def test_clock(spark):
    df = spark.createDataFrame([(9000,), (-1,), (8999,)], "ms bigint")
    assert [r[0] for r in df.select(clock.window_floor(F.col("ms"), 3000)).collect()] == [9000, -3000, 6000]
    row = spark.range(1).select(
        clock.day_of(F.lit(1704067207179)), clock.hour_of(F.lit(1704067207179)),
        clock.date_text_part(F.lit("2024-01-02 03:04:05")), clock.hour_text_part(F.lit("2024-01-02 03:04:05"))).first()
    assert tuple(row) == ("2024-01-01", "00", "2024-01-02", "03")


def test_milliseconds_do_not_depend_on_the_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS t")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert df.select(clock.epoch_ms("t")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_and_operations(spark):
    assert column(spark, ["insert", "update", "delete", "bootstrap-insert", "ddl", None], operation) == ["I", "U", "D", "I", None, None]
    assert column(spark, ["order_info"], lambda c: text.upper_name("DWD", c, F.lit("I"))) == ["DWD_ORDER_INFO_I"]
    assert column(spark, ["A b", "ab ", "abc"], lambda c: text.equal_ignore_space_case(c, F.lit("a B"))) == ["yes", "yes", "no"]
