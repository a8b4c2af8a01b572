"""Inputs of the pipelines, derived from the analytic tables.

Clicks, raw logs, change records, order headers and dimensions do not exist as tables; each is a projection
of one, so the work of every query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamloom.functions.clock import epoch_ms
from streamloom.sources.files import read_table


def clicks_of(events: DataFrame) -> DataFrame:
    """``events`` as clicks in arrival order: user, url, timestamp (ms), ts, seq. Batch or streaming."""
    return events.select(
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("url"),
        epoch_ms("ts").alias("timestamp"),
        F.timestamp_millis(epoch_ms("ts")).alias("ts"),
        F.col("event_id").alias("seq"),
    )


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return clicks_of(read_table(spark, sf, "events"))


def disordered_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks arriving out of order: by ``(seq + seq*7919 % 97, seq)``, as one unique number."""
    shift = F.pmod(F.col("seq") * 7919, F.lit(97))
    arrival = (F.col("seq") + shift) * 97 + (96 - shift)
    return clicks(spark, sf).withColumn("event_id", F.col("seq")).withColumn("seq", arrival)


def sensors(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as sensor readings: id s0…s3, ts (ms), vc, seq."""
    events = read_table(spark, sf, "events")
    return events.select(
        F.concat(F.lit("s"), F.col("user_id") % 4).alias("id"),
        epoch_ms("ts").alias("ts"),
        F.floor(F.col("value")).cast("int").alias("vc"),
        F.col("event_id").alias("seq"),
    )


def raw_logs_of(events: DataFrame) -> DataFrame:
    """``events`` as raw log JSON. Batch or streaming."""
    n, user, kind, ms = F.col("event_id"), F.col("user_id"), F.col("event_type"), epoch_ms("ts")

    def numbered(prefix: str, number: Column) -> Column:
        return F.concat(F.lit(prefix), number)

    item = (n % 100).cast("string")
    page = F.struct(
        kind.alias("page_id"), item.alias("item"), F.lit("sku").alias("item_type"),
        F.when(n % 3 != 0, "home").alias("last_page_id"), (n % 1000).alias("during_time"),
    )

    def action(i: int) -> Column:
        return F.struct(
            numbered("act_", F.lit(i)).alias("action_id"), item.alias("item"),
            F.lit("sku").alias("item_type"), (ms + i).alias("ts"),
        )

    actions = F.when(kind == "click", F.array(action(1))).when(kind == "purchase", F.array(action(1), action(2)))
    displays = F.transform(
        F.when(n % 4 > 0, F.sequence(F.lit(1).cast("bigint"), n % 4)),
        lambda i: F.struct(
            F.lit("promo").alias("display_type"), ((n + i) % 100).cast("string").alias("item"),
            F.lit("sku").alias("item_type"), i.cast("string").alias("order"), numbered("pos_", i).alias("pos_id"),
        ),
    )
    start = F.struct(
        F.lit("icon").alias("entry"), numbered("ad_", n % 20).alias("open_ad_id"), (n % 500).alias("loading_time_ms"),
        (n % 300).alias("open_ad_ms"), (n % 50).alias("open_ad_skip_ms"),
    )
    common = F.struct(
        numbered("mid_", user).alias("mid"), user.cast("string").alias("uid"), (user % 25).cast("string").alias("ar"),
        numbered("ch_", n % 3).alias("ch"), numbered("os_", n % 2).alias("os"), numbered("md_", user % 7).alias("md"),
        numbered("v", n % 5).alias("vc"), (n % 2).cast("string").alias("is_new"),
    )
    viewed = kind.isin("view", "click", "purchase")
    log = F.struct(
        common.alias("common"),
        F.when(viewed, page).alias("page"),
        F.when(viewed, actions).alias("actions"),
        F.when(viewed, displays).alias("displays"),
        F.when((kind == "signup") | (n % 10 == 0), start).alias("start"),
        F.when(kind == "error", F.struct((n % 7).alias("error_code"), F.lit("failed").alias("msg"))).alias("err"),
        ms.alias("ts"),
    )
    return events.select(F.to_json(log).alias("value"))


def raw_logs(spark: SparkSession, sf: str) -> DataFrame:
    return raw_logs_of(read_table(spark, sf, "events"))


def _change(kind: Column, table: str, data: Column, seq: Column) -> list[Column]:
    return [F.to_json(F.struct(kind.alias("type"), F.lit(table).alias("table"), data.alias("data"))).alias("value"), seq.alias("seq")]


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change records of orders (fact), customers and nations (dimensions) and parts (neither)."""
    key = F.col("o_orderkey")
    kind = (
        F.when(key % 5 == 0, "insert").when(key % 5 == 1, "update").when(key % 5 == 2, "delete")
        .when(key % 5 == 3, "bootstrap-insert").otherwise("ddl")
    )
    order = F.struct(key.alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("order_status"),
                     F.col("o_totalprice").cast("decimal(15,2)").alias("total_amount"))
    orders = read_table(spark, sf, "orders").select(*_change(kind, "order_info", order, key))

    customer = read_table(spark, sf, "customer").withColumn(
        "version", F.explode(F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1))))
    )
    version = F.col("version")
    user = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), version.alias("version"),
        *[c.alias(n) for n, c in user_formula().items()],
    )
    kind = F.when(version == 0, "insert").when(version == 1, "update").otherwise("delete")
    users = customer.select(*_change(kind, "user_info", user, F.col("c_custkey") * 3 + version))

    nation = read_table(spark, sf, "nation")
    province = F.struct(F.col("n_nationkey").alias("id"), *[c.alias(n) for n, c in province_formula().items()])
    provinces = nation.select(*_change(F.lit("bootstrap-insert"), "base_province", province, F.col("n_nationkey").cast("bigint")))

    sku = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    skus = read_table(spark, sf, "part").select(*_change(F.lit("insert"), "sku_info", sku, F.col("p_partkey")))
    return orders.unionByName(users).unionByName(provinces).unionByName(skus)


def user_formula() -> dict[str, Column]:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key * 37 % 15000).cast("int"))
    return {"gender": F.when(key % 2 == 0, "M").otherwise("F"), "birthday": born.cast("string")}


def province_formula() -> dict[str, Column]:
    key = F.col("n_nationkey")
    return {
        "name": F.col("n_name"),
        "iso_code": F.concat(F.lit("ISO-"), key),
        "iso_3166_2": F.concat(F.lit("X-"), key),
        "area_code": F.concat(F.lit("R"), F.col("n_regionkey"), F.lit("-"), key),
    }


def user_dim(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), *[c.alias(n) for n, c in user_formula().items()]
    )


def province_dim(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), *[c.alias(n) for n, c in province_formula().items()]
    )


def order_headers_of(orders: DataFrame) -> DataFrame:
    """``orders`` as order headers; the hour comes from the key. Batch or streaming."""
    key = F.col("o_orderkey")
    created = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":15:00"))
    return orders.select(
        key.alias("id"), (F.col("o_custkey") % 30).alias("province_id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("total_amount"),
        F.lit(0.0).alias("activity_reduce_amount"), F.lit(0.0).alias("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"), F.lit(0.0).alias("feight_fee"),
        F.lit(0.0).alias("feight_fee_reduce"), created.alias("create_time"),
    )


def order_details_of(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as order details. Batch or streaming."""
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"), F.concat(F.lit("sku_"), F.col("l_partkey")).alias("sku_name"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 08:30:00")).alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"), F.lit(0.0).alias("split_activity_amount"),
        F.lit(0.0).alias("split_coupon_amount"),
    )
