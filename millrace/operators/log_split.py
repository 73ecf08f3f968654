"""Raw app logs to five event records.

A record with an error goes to the error route alone, whole. Any other record
gives a page row when it has a page, a row per display and per action of that
page, and a start row when it has a start; page and start exclude nothing.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.exprs import plausible
from millrace.functions.parse import json_text, with_json
from millrace.schemas import APP_LOG

# Route names.
PAGE_TOPIC = "DWD_PAGE_LOG_TOPIC"
DISPLAY_TOPIC = "DWD_PAGE_DISPLAY_TOPIC"
ACTION_TOPIC = "DWD_PAGE_ACTION_TOPIC"
START_TOPIC = "DWD_START_LOG_TOPIC"
ERROR_TOPIC = "DWD_ERROR_LOG_TOPIC"
# Our own route for rows that cannot be read.
REJECTED_TOPIC = "REJECTED_BASE_LOG"

COMMON = ["common", "ts"]


def parse_log(messages: DataFrame) -> DataFrame:
    """Messages with their record ``j`` and its fate: ``rejected``, ``error`` or ``log``.

    A record is rejected when its text is not an object, or when it is no error
    and lacks the common block or a time that a clock can show.
    """
    parsed = with_json(messages, APP_LOG)
    j = F.col("j")
    fate = (
        F.when(j.isNull(), "rejected")
        .when(j["err"].isNotNull(), "error")
        .when(j["common"].isNull() | ~plausible(j["ts"]), "rejected")
        .otherwise("log")
    )
    return parsed.withColumn("fate", fate)


def _common_fields() -> list[Column]:
    c = F.col("j")["common"]
    return [
        c["mid"].alias("mid"),
        c["uid"].alias("user_id"),
        c["ar"].alias("province_id"),
        c["ch"].alias("channel"),
        c["is_new"].alias("is_new"),
        c["md"].alias("model"),
        c["os"].alias("operate_system"),
        c["vc"].alias("version_code"),
        c["ba"].alias("brand"),
    ]


def _page_fields() -> list[Column]:
    p = F.col("j")["page"]
    return [
        p["page_id"].alias("page_id"),
        p["last_page_id"].alias("last_page_id"),
        p["item"].alias("page_item"),
        p["item_type"].alias("page_item_type"),
        p["during_time"].alias("during_time"),
        p["source_type"].alias("sourceType"),
    ]


def _display_fields(d: Column) -> list[Column]:
    return [
        d["display_type"].alias("display_type"),
        d["item"].alias("display_item"),
        d["item_type"].alias("display_item_type"),
        d["order"].alias("display_order"),
        d["pos_id"].alias("display_pos_id"),
    ]


def _action_fields(a: Column) -> list[Column]:
    return [
        a["action_id"].alias("action_id"),
        a["item"].alias("action_item"),
        a["item_type"].alias("action_item_type"),
        a["ts"].alias("action_ts"),
    ]


def _start_fields() -> list[Column]:
    s = F.col("j")["start"]
    return [
        s["entry"].alias("entry"),
        s["open_ad_id"].alias("open_ad_id"),
        s["loading_time"].alias("loading_time_ms"),
        s["open_ad_ms"].alias("open_ad_ms"),
        s["open_ad_skip_ms"].alias("open_ad_skip_ms"),
    ]


def _ts() -> Column:
    return F.col("j")["ts"].alias("ts")


def _elements(name: str) -> Column:
    """The array without null elements; a null array counts as empty."""
    return F.filter(F.col("j")[name], lambda item: item.isNotNull())


def _logs(parsed: DataFrame) -> DataFrame:
    return parsed.where("fate = 'log'")


def _pages(parsed: DataFrame) -> DataFrame:
    return _logs(parsed).where(F.col("j")["page"].isNotNull())


def error_log(parsed: DataFrame, *extra: str) -> DataFrame:
    return parsed.where("fate = 'error'").select("value", *extra)


def rejected_log(parsed: DataFrame, *extra: str) -> DataFrame:
    return parsed.where("fate = 'rejected'").select("value", *extra)


def page_log(parsed: DataFrame, *extra: str | Column) -> DataFrame:
    return _pages(parsed).select(*_common_fields(), *_page_fields(), _ts(), *extra)


def display_log(parsed: DataFrame) -> DataFrame:
    each = _pages(parsed).withColumn("d", F.explode(_elements("display")))
    return each.select(*_common_fields(), *_page_fields(), *_display_fields(F.col("d")), _ts())


def action_log(parsed: DataFrame) -> DataFrame:
    each = _pages(parsed).withColumn("a", F.explode(_elements("actions")))
    return each.select(*_common_fields(), *_page_fields(), *_action_fields(F.col("a")), _ts())


def start_log(parsed: DataFrame) -> DataFrame:
    started = _logs(parsed).where(F.col("j")["start"].isNotNull())
    return started.select(*_common_fields(), *_start_fields(), _ts())


def _message(topic: str, value: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"))


def fan_out(parsed: DataFrame, *extra: str) -> DataFrame:
    """All routes at once, as ``(topic, key, value)`` and the message columns ``extra``.

    Each row builds the messages it gives as one array, so the input is read
    and parsed once; five filtered branches would read it five times. The key
    is the device, which keeps one device's messages in order.
    """
    common, page, ts = _common_fields(), _page_fields(), _ts()
    none = F.expr("cast(array() as array<struct<topic:string,value:string>>)")

    def repeated(name, topic, fields):
        made = F.transform(
            _elements(name),
            lambda item: _message(topic, json_text(*common, *page, *fields(item), ts)),
        )
        return F.coalesce(made, none)

    has_page = F.col("j")["page"].isNotNull()
    pages = F.when(
        has_page,
        F.concat(
            F.array(_message(PAGE_TOPIC, json_text(*common, *page, ts))),
            repeated("display", DISPLAY_TOPIC, _display_fields),
            repeated("actions", ACTION_TOPIC, _action_fields),
        ),
    ).otherwise(none)
    start = F.when(
        F.col("j")["start"].isNotNull(),
        F.array(_message(START_TOPIC, json_text(*common, *_start_fields(), ts))),
    ).otherwise(none)
    out = (
        F.when(F.col("fate") == "error", F.array(_message(ERROR_TOPIC, F.col("value"))))
        .when(F.col("fate") == "rejected", F.array(_message(REJECTED_TOPIC, F.col("value"))))
        .otherwise(F.concat(pages, start))
    )
    key = F.col("j")["common"]["mid"].alias("key")
    each = parsed.select(key, *extra, F.explode(out).alias("m"))
    return each.select("m.topic", "key", "m.value", *extra)
