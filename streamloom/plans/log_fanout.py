"""Raw application log (JSON text in ``value``) → error, page, action, display and start logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from streamloom.functions.json import to_rows
from streamloom.schemas import RAW_LOG

# Output topics.
TOPICS = {
    "error": "DWD_ERROR_INFO_1018",
    "page": "DWD_PAGE_LOG_1018",
    "action": "DWD_PAGE_ACTION_1018",
    "display": "DWD_PAGE_DISPLAY_1018",
    "start": "DWD_START_LOG_1018",
}
# What each output reads of a log.
PAGE_PARTS = ("common", "page", "err", "ts")
ACTION_PARTS = (*PAGE_PARTS, "actions")
DISPLAY_PARTS = (*ACTION_PARTS, "displays")
START_PARTS = ("common", "start", "err", "ts")


def _visitor() -> list[Column]:
    common = {
        "mid": "mid", "uid": "user_id", "ar": "province_id", "ch": "channel",
        "is_new": "is_new", "md": "model", "os": "operate_system", "vc": "version_code",
    }
    return [F.col(f"common.{source}").alias(name) for source, name in common.items()]


def _page() -> list[Column]:
    page = {
        "page_id": "page_id", "last_page_id": "last_page_id", "item": "page_item",
        "item_type": "page_item_type", "during_time": "during_time",
    }
    return [F.col(f"page.{source}").alias(name) for source, name in page.items()]


def _action_fields(a: Column) -> list[Column]:
    return [
        a["action_id"].alias("action_id"), a["item"].alias("action_item"),
        a["item_type"].alias("action_item_type"), a["ts"].alias("ts"),
    ]


def _display_fields(d: Column) -> list[Column]:
    return [
        d["display_type"].alias("display_type"), d["item"].alias("display_item"),
        d["item_type"].alias("display_item_type"), d["order"].alias("display_order"),
        d["pos_id"].alias("display_pos_id"), F.col("ts"),
    ]


def _start_fields() -> list[Column]:
    names = ["entry", "open_ad_id", "loading_time_ms", "open_ad_ms", "open_ad_skip_ms"]
    return [*[F.col(f"start.{n}").alias(n) for n in names], F.col("ts")]


def _is_page() -> Column:
    return F.col("err").isNull() & F.col("page").isNotNull()


def parse_logs(raw: DataFrame, *parts: str) -> DataFrame:
    """Parse each text once, reading only the ``parts`` named (default: all). Batch or streaming."""
    return to_rows(raw.select("value"), "value", {p: RAW_LOG[p] for p in parts or RAW_LOG}, raw=("err",))


def log_error(logs: DataFrame) -> DataFrame:
    """The error object alone; a log with an error gives nothing else."""
    return logs.filter("err IS NOT NULL").select("err")


def log_page(logs: DataFrame) -> DataFrame:
    return logs.filter(_is_page()).select(*_visitor(), *_page(), "ts")


def log_action(logs: DataFrame) -> DataFrame:
    """One row per action, with the action's own time."""
    rows = logs.filter(_is_page()).withColumn("a", F.explode("actions"))
    return rows.select(*_visitor(), *_page(), *_action_fields(F.col("a")))


def log_display(logs: DataFrame, need_action: bool = True) -> DataFrame:
    """One row per display, with the page's time; as a rule only for pages that have an action."""
    rows = logs.filter(_is_page())
    if need_action:
        rows = rows.filter(F.size("actions") > 0)
    rows = rows.withColumn("d", F.explode("displays"))
    return rows.select(*_visitor(), *_page(), *_display_fields(F.col("d")))


def log_display_all(logs: DataFrame) -> DataFrame:
    """Displays of every page."""
    return log_display(logs, need_action=False)


def log_start(logs: DataFrame) -> DataFrame:
    """Application starts, independent of pages."""
    return logs.filter("err IS NULL AND start IS NOT NULL").select(*_visitor(), *_start_fields())


def route_logs(raw: DataFrame) -> DataFrame:
    """All five outputs as ``(topic, value)`` rows in one pass over the log. Batch or streaming."""
    logs = parse_logs(raw)

    def message(output: str, value: Column) -> Column:
        return F.struct(F.lit(TOPICS[output]).alias("topic"), value.alias("value"))

    none = F.array().cast("array<struct<topic:string,value:string>>")

    def many(items: str, output: str, fields) -> Column:
        to_message = lambda x: message(output, F.to_json(F.struct(*_visitor(), *_page(), *fields(x))))
        return F.coalesce(F.transform(items, to_message), none)

    page = F.array(message("page", F.to_json(F.struct(*_visitor(), *_page(), F.col("ts")))))
    displays = F.when(F.size("actions") > 0, many("displays", "display", _display_fields)).otherwise(none)
    of_page = F.when(F.col("page").isNotNull(), F.concat(page, many("actions", "action", _action_fields), displays))
    of_start = F.when(
        F.col("start").isNotNull(), F.array(message("start", F.to_json(F.struct(*_visitor(), *_start_fields()))))
    )
    out = F.when(F.col("err").isNotNull(), F.array(message("error", F.col("err")))).otherwise(
        F.concat(F.coalesce(of_page, none), F.coalesce(of_start, none))
    )
    return logs.select(F.explode(out).alias("m")).select("m.*")
