"""Record types of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "date": DateType()}


def _schema(fields: str) -> StructType:
    """Flat schema from ``name type [not null], …``, built without a session."""
    schema = StructType()
    for field in fields.split(", "):
        name, kind, *not_null = field.split(" ")
        schema.add(name, _TYPES[kind], not not_null)
    return schema


CLICK = _schema("user string, url string, timestamp bigint")
SENSOR = _schema("id string, ts bigint, vc int")
STUDENT_EVENT = _schema("name string, timestamp bigint, num int not null")
WINDOW_COUNT = _schema("url string, count bigint, start bigint, end bigint")
EMPLOYEE = _schema(
    "empno int, ename string, job string, mgr int, hiredate date, sal double, comm double, deptno int"
)
STUDENT = _schema(
    "sid int, studentName string, studentAge int, studentScore double, studentClass int"
)
CLASS = _schema("cid int, className string")

_VISITOR = (
    "mid string, user_id string, province_id string, channel string, is_new string, "
    "model string, operate_system string, version_code string"
)
_PAGE = "page_id string, last_page_id string, page_item string, page_item_type string, during_time bigint"

PAGE_LOG = _schema(f"{_VISITOR}, {_PAGE}, ts bigint")
PAGE_ACTION_LOG = _schema(
    f"{_VISITOR}, {_PAGE}, action_id string, action_item string, action_item_type string, ts bigint"
)
PAGE_DISPLAY_LOG = _schema(
    f"{_VISITOR}, {_PAGE}, display_type string, display_item string, display_item_type string, "
    "display_order string, display_pos_id string, ts bigint"
)
START_LOG = _schema(
    f"{_VISITOR}, entry string, open_ad_id string, loading_time_ms bigint, open_ad_ms bigint, "
    "open_ad_skip_ms bigint, ts bigint"
)
DAU = _schema(
    f"{_VISITOR}, page_id string, page_item string, page_item_type string, during_time bigint, "
    "user_gender string, user_age string, province_name string, province_iso_code string, "
    "province_3166_2 string, province_area_code string, dt string, hr string, ts bigint"
)

_ORDER_BODY = (
    "province_id bigint, order_status string, user_id bigint, total_amount double, "
    "activity_reduce_amount double, coupon_reduce_amount double, original_total_amount double, "
    "feight_fee double, feight_fee_reduce double, expire_time string, refundable_time string, "
    "create_time string, operate_time string, create_date string, create_hour string, "
    "province_name string, province_area_code string, province_3166_2_code string, "
    "province_iso_code string, user_age int, user_gender string"
)
_DETAIL_AMOUNTS = (
    "split_total_amount double, split_activity_amount double, split_coupon_amount double"
)
ORDER_INFO = _schema(f"id bigint, {_ORDER_BODY}")
ORDER_DETAIL = _schema(
    "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, "
    f"sku_name string, create_time string, {_DETAIL_AMOUNTS}"
)
ORDER_WIDE = _schema(
    "detail_id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint, "
    f"sku_name string, {_DETAIL_AMOUNTS}, {_ORDER_BODY}"
)

# Nested types are given as text. Raw log: err is kept as JSON text, because only the object itself is passed on.
RAW_LOG = {
    "common": "struct<mid:string,uid:string,ar:string,ch:string,os:string,md:string,vc:string,is_new:string>",
    "page": "struct<page_id:string,item:string,item_type:string,last_page_id:string,during_time:bigint>",
    "actions": "array<struct<action_id:string,item:string,item_type:string,ts:bigint>>",
    "displays": "array<struct<display_type:string,item:string,item_type:string,order:string,pos_id:string>>",
    "start": "struct<entry:string,open_ad_id:string,loading_time_ms:bigint,open_ad_ms:bigint,open_ad_skip_ms:bigint>",
    "err": "string",
    "ts": "bigint",
}
CDC = {"type": "string", "table": "string", "data": "string"}
USER_DIM = _schema("gender string, birthday string")
PROVINCE_DIM = _schema("name string, iso_code string, iso_3166_2 string, area_code string")


def copy_same_name(df: DataFrame, target: StructType) -> DataFrame:
    """Shape rows as ``target``: fields of the same name and type are copied, the rest are NULL."""
    have = {field.name: field.dataType for field in df.schema.fields}
    return df.select(
        *[
            (F.col(f.name) if have.get(f.name) == f.dataType else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )
