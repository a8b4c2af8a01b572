"""Text and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamloom.catalog.joins import TODAY
from streamloom.catalog.registry import LINES, query
from streamloom.functions import clock, text
from streamloom.functions.arithmetic import calculate
from streamloom.operators.placement import over_all_cores
from streamloom.plans.cdc import operation
from streamloom.plans.derived import clicks
from streamloom.sources.files import read_table


@query("str_split", f"WITH {LINES} SELECT doc_id, len(string_split(line, ' ')) AS pieces FROM lines")
def _(spark, sf):
    rows = read_table(spark, sf, "documents").select("doc_id", F.explode(text.lines(F.col("text"))).alias("line"))
    return rows.select("doc_id", F.size(F.split("line", " ")).alias("pieces"))


@query("str_equal_ignore_space_case", """
    SELECT p_partkey, CASE WHEN lower(replace(p_name, ' ', '')) = 'redwidget' THEN 'yes' ELSE 'no' END AS same FROM part""")
def _(spark, sf):
    same = text.equal_ignore_space_case(F.col("p_name"), F.lit("RED  Widget"))
    return read_table(spark, sf, "part").select("p_partkey", same.alias("same"))


@query("str_upper_concat", """
    SELECT c_custkey, 'DIM_' || upper(c_mktsegment) || '_' || c_custkey AS name FROM customer""")
def _(spark, sf):
    name = text.upper_name("DIM", F.lower("c_mktsegment"), F.col("c_custkey").cast("string"))
    return read_table(spark, sf, "customer").select("c_custkey", name.alias("name"))


@query("ms_to_day", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt FROM events")
def _(spark, sf):
    return clicks(spark, sf).select(F.col("seq").alias("event_id"), clock.day_of(F.col("timestamp")).alias("dt"))


@query("ms_to_dt_hr", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events")
def _(spark, sf):
    ms = F.col("timestamp")
    return clicks(spark, sf).select(F.col("seq").alias("event_id"), clock.day_of(ms).alias("dt"), clock.hour_of(ms).alias("hr"))


@query("str_dt_hr", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events")
def _(spark, sf):
    rows = read_table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    return rows.select("event_id", clock.date_text_part(F.col("at")).alias("dt"), clock.hour_text_part(F.col("at")).alias("hr"))


@query("age_years", f"""
    SELECT o_orderkey, CAST(date_part('year', DATE '{TODAY}') - date_part('year', o_orderdate)
        - CASE WHEN strftime(DATE '{TODAY}', '%m%d') < strftime(o_orderdate, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS years
    FROM orders""")
def _(spark, sf):
    years = clock.age_years(F.col("o_orderdate").cast("date"), F.lit(TODAY).cast("date"))
    return read_table(spark, sf, "orders").select("o_orderkey", years.alias("years"))


@query("case_op_type", """
    SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'I' WHEN 1 THEN 'U' WHEN 2 THEN 'D' WHEN 3 THEN 'I' END AS op FROM orders""")
def _(spark, sf):
    names = F.array(*[F.lit(n) for n in ("insert", "update", "delete", "bootstrap-insert", "ddl")])
    kind = F.element_at(names, (F.col("o_orderkey") % 5 + 1).cast("int"))
    return read_table(spark, sf, "orders").select("o_orderkey", operation(kind).alias("op"))


@query("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("json_emit", """
    SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"kind":"' || event_type || '"'
        || CASE WHEN event_id % 3 = 0 THEN ',"third":1' ELSE '' END || '}' AS value FROM events""")
def _(spark, sf):
    record = F.struct("event_id", "user_id", F.col("event_type").alias("kind"), F.when(F.col("event_id") % 3 == 0, 1).alias("third"))
    return read_table(spark, sf, "events").select("event_id", F.to_json(record).alias("value"))


@query("parse_int_mod", "SELECT event_id, CAST(user_id % 2 AS INTEGER) AS rest FROM events")
def _(spark, sf):
    return clicks(spark, sf).select(F.col("seq").alias("event_id"), (F.col("user").cast("int") % 2).alias("rest"))


@query("double_div", "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) / (o_orderkey + 1) AS ratio FROM orders")
def _(spark, sf):
    ratio = F.col("o_custkey").cast("double") / (F.col("o_orderkey") + 1)
    return read_table(spark, sf, "orders").select("o_orderkey", ratio.alias("ratio"))


@query("calculate", """
    SELECT l_orderkey, l_partkey, (l_quantity * l_extendedprice + l_tax) / (1 + l_discount) AS value FROM lineitem""")
def _(spark, sf):
    expression = F.concat(
        F.lit("("), F.col("l_quantity"), F.lit("*"), F.col("l_extendedprice"), F.lit(" + "), F.col("l_tax"),
        F.lit(") / (1+"), F.col("l_discount"), F.lit(")"),
    )
    needed = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount"]
    rows = over_all_cores(read_table(spark, sf, "lineitem").select(*needed)).select("l_orderkey", "l_partkey", calculate(expression).alias("value"))
    return rows.withColumn("value", F.col("value").cast("double"))


_NUMERAL_DIGITS = "零壹贰叁肆伍陆柒捌玖"


@query("transform_digit", """
    WITH digits AS (
        SELECT l_orderkey, l_partkey, l_partkey // 1000 % 10 AS a, l_partkey // 100 % 10 AS b, l_partkey // 10 % 10 AS c,
            l_partkey % 10 AS d, l_orderkey // 10 % 10 AS e, l_orderkey % 10 AS f FROM lineitem)
    SELECT l_orderkey, l_partkey,
        CAST(a AS DOUBLE) * 1000 + CAST(b AS DOUBLE) * 100 + CAST(CASE WHEN d > 0 THEN d ELSE 10 END AS DOUBLE)
            + CAST(e AS DOUBLE) * CAST(0.1 AS DOUBLE) + CAST(f AS DOUBLE) * CAST(0.01 AS DOUBLE) AS number FROM digits""")
def _(spark, sf):
    part, order = F.col("l_partkey"), F.col("l_orderkey")

    def digit(number, tens):
        return F.substr(F.lit(_NUMERAL_DIGITS), (F.floor(number / tens) % 10 + 1).cast("int"), F.lit(1))

    numeral = F.concat(
        digit(part, 1000), F.lit("仟"), digit(part, 100), F.lit("佰"), digit(part, 10), F.lit("拾"), digit(part, 1),
        F.lit("元整"), digit(order, 10), F.lit("角"), digit(order, 1), F.lit("分"),
    )
    keys = over_all_cores(read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"))
    rows = keys.select("l_orderkey", "l_partkey", text.numeral_to_number(numeral).alias("number"))
    return rows.withColumn("number", F.col("number").cast("double"))


def _scripts(spark, sf):
    key = F.col("p_partkey").cast("string")
    script = F.concat(
        F.lit("drop table if exists dm.part_"), key, F.lit(";\nCREATE TABLE IF NOT EXISTS dm.part_"), key,
        F.lit("\n(id bigint) stored as orc;\ncreate  table stage_"), key,
        F.lit(" as select 1;\ninsert overwrite table dm_temp.part_"), key,
        F.lit(" select * from stage_"), key, F.lit(";\nInsert  Overwrite\ntable dm.part_"), key, F.lit(" select 1;"),
    )
    return read_table(spark, sf, "part").select("p_partkey", script.alias("script"))


@query("extract_tables", """
    SELECT p_partkey, 0 AS pos, 'dm.part_' || p_partkey AS name FROM part
    UNION ALL SELECT p_partkey, 1, 'stage_' || p_partkey FROM part
    UNION ALL SELECT p_partkey, 2, 'dm_temp.part_' || p_partkey FROM part
    UNION ALL SELECT p_partkey, 3, 'dm.part_' || p_partkey FROM part""")
def _(spark, sf):
    return _scripts(spark, sf).select("p_partkey", F.posexplode(text.script_tables(F.col("script"))).alias("pos", "name"))


@query("extract_insert_targets", """
    SELECT p_partkey, 0 AS pos, 'dm_temp.part_' || p_partkey AS name FROM part
    UNION ALL SELECT p_partkey, 1, 'dm.part_' || p_partkey FROM part""")
def _(spark, sf):
    return _scripts(spark, sf).select("p_partkey", F.posexplode(text.script_overwrites(F.col("script"))).alias("pos", "name"))
