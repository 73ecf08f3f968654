"""The registered queries: each operator over the whole of its tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from millrace.functions.exprs import (
    completed_years,
    date_part,
    event_date,
    event_hour,
    hour_part,
)
from millrace.functions.parse import json_text
from millrace.operators import cdc, dau, log_split, orders
from millrace.operators.keyed import end_offsets as end_offsets_of
from millrace.plans import standins as given
from millrace.schemas import DIMENSION_ROW, ORDER_WIDE, plus
from millrace.session import shared_folder
from millrace.sinks.batches import read_batches, read_latest, write_batch
from millrace.sources.tables import table

# --- parsing and scalar functions ---


def json_field(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, sf, "events").select("event_id", k.alias("k"))


def json_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Ids as quoted numbers, amounts quoted, fractional or missing."""
    h = given.headers(spark, sf)
    status = F.col("order_status")
    quoted = h.select(
        json_text(
            F.col("id").cast("string").alias("id"),
            "province_id",
            "order_status",
            "user_id",
            F.when(status == "O", F.col("total_amount").cast("string")).alias("total_amount"),
            "activity_reduce_amount",
            "freight_fee",
            "create_time",
        ).alias("value")
    )
    return orders.headers_of(orders.parse_headers(quoted))


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    lines = given.lines(spark, sf)
    return orders.lines_of(orders.parse_lines(lines.select(json_text(*lines.columns).alias("value"))))


def dt_hr(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return (
        table(spark, sf, "events")
        .select("event_id", ms.alias("ms"))
        .select("event_id", event_date(F.col("ms")).alias("dt"), event_hour(F.col("ms")).alias("hr"))
    )


def create_date_hour(spark: SparkSession, sf: str) -> DataFrame:
    created = F.col("create_time")
    return given.headers(spark, sf).select(
        "id", date_part(created).alias("create_date"), hour_part(created).alias("create_hour")
    )


def age_years(spark: SparkSession, sf: str) -> DataFrame:
    """Ages on a day after every birthday and on one amid them."""
    born = F.col("o_orderdate").cast("date")
    amid = F.lit("1998-03-01").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        completed_years(born, F.lit(given.AS_OF)).alias("age_after"),
        completed_years(born, amid).alias("age_amid"),
    )


# --- change records ---


def cdc_op_map(spark: SparkSession, sf: str) -> DataFrame:
    changes = cdc.parse_changes(given.changes(spark, sf))
    return changes.groupBy("table", "type", "op").agg(F.count("*").alias("n"))


def cdc_fact_route(spark: SparkSession, sf: str) -> DataFrame:
    changes = cdc.parse_changes(given.changes(spark, sf))
    return cdc.fact_messages(changes, given.names(spark, given.FACT_TABLES)).select("topic", "key")


def cdc_fact_payload(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of each fact's payload; amounts have more digits than a double holds."""
    changes = cdc.parse_changes(given.exact_changes(spark, sf))
    routed = cdc.fact_messages(changes, given.names(spark, given.FACT_TABLES))
    field = lambda name, kind: F.try_variant_get(F.try_parse_json("value"), f"$.{name}", kind)
    return routed.select(
        "topic",
        "key",
        field("amount", "decimal(38,9)").cast("string").alias("amount"),
        field("note", "string").alias("note"),
        field("parts[1].n", "bigint").alias("n"),
    )


def json_whole_text(spark: SparkSession, sf: str) -> DataFrame:
    """One order in five has a second object, or something else, behind its own."""
    changes = cdc.parse_changes(given.trailed_changes(spark, sf))
    return changes.select("offset", "rejected", "table", F.get_json_object("data", "$.id").alias("id"))


def cdc_dim_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages are parsed once, for both tables: the current rows are stored between."""
    path = shared_folder(spark) + "/current"
    dims = given.names(spark, given.DIM_TABLES)
    changes = cdc.parse_changes(given.changes(spark, sf), dims)
    cdc.current_rows(cdc.dimension_rows(changes, dims)).write.parquet(path)
    current = spark.read.schema(DIMENSION_ROW).parquet(path)
    users = cdc.user_info(current).select(F.lit("user_info").alias("table"), "id", F.col("gender").alias("what"))
    provinces = cdc.base_province(current).select(
        F.lit("base_province").alias("table"), "id", F.col("name").alias("what")
    )
    return users.unionByName(provinces)


def _current_users(spark: SparkSession, sf: str, on_delete: str) -> DataFrame:
    changes = cdc.parse_changes(given.user_versions(spark, sf))
    rows = cdc.dimension_rows(changes, given.names(spark, given.DIM_TABLES))
    return cdc.user_info(cdc.current_rows(rows, on_delete))


def cdc_dim_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _current_users(spark, sf, "keep")


def cdc_dim_drop(spark: SparkSession, sf: str) -> DataFrame:
    return _current_users(spark, sf, "drop")


# --- log split ---


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.parse_log(given.app_log(spark, sf))


def log_error_split(spark: SparkSession, sf: str) -> DataFrame:
    errors = log_split.error_log(_logs(spark, sf))
    field = lambda path: F.get_json_object("value", path)
    return errors.select(
        field("$.common.mid").alias("mid"),
        field("$.err.error_code").cast("bigint").alias("error_code"),
        field("$.ts").cast("bigint").alias("ts"),
    )


def log_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.rejected_log(_logs(spark, sf), "partition", "offset").drop("value")


def log_page(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.page_log(_logs(spark, sf))


def log_display(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.display_log(_logs(spark, sf))


def log_action(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.action_log(_logs(spark, sf))


def log_start(spark: SparkSession, sf: str) -> DataFrame:
    return log_split.start_log(_logs(spark, sf))


def log_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return routed_fields(log_split.fan_out(_logs(spark, sf)))


def routed_fields(routed: DataFrame) -> DataFrame:
    """Each routed message: its topic, key and some fields of its text."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return routed.select(
        "topic",
        "key",
        field("ts").try_cast("bigint").alias("ts"),
        field("page_id").alias("page_id"),
        field("during_time").try_cast("bigint").alias("during_time"),
        F.coalesce(field("display_item"), field("action_item"), field("open_ad_id")).alias("item"),
    )


# --- daily actives ---


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return dau.with_day(dau.entry_pages(log_split.page_log(_logs(spark, sf), "offset")))


def _firsts(spark: SparkSession, sf: str) -> DataFrame:
    return dau.first_of_day(_entries(spark, sf), ("ts", "offset"))


def dau_entry(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("offset", "mid", "dt", "page_id")


def dau_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _firsts(spark, sf).select("dt", "mid", "offset", "ts", "page_item", "during_time")


def dau_bad_time(spark: SparkSession, sf: str) -> DataFrame:
    """Some devices tell micro- or nanoseconds: rejected, with their place in the input."""
    parsed = dau.entries_or_rejected(dau.parse_pages(given.odd_pages(spark, sf)))
    day = F.when(~F.col("rejected"), F.col("dt"))
    return parsed.select("partition", "offset", "rejected", day.alias("dt"))


def dau_wide(spark: SparkSession, sf: str) -> DataFrame:
    return dau.dau_info(
        _firsts(spark, sf), given.users(spark, sf), given.provinces(spark, sf), given.AS_OF
    )


def dau_restore(spark: SparkSession, sf: str) -> DataFrame:
    """Days before the cut are stored whole, later ones for new devices alone."""
    firsts = _firsts(spark, sf)
    stored = firsts.where((F.col("dt") < "2024-01-16") | (F.col("is_new") == "1"))
    return dau.not_yet_stored(firsts, stored).select("dt", "mid", "offset")


# --- orders ---


def order_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return orders.enrich_headers(
        given.headers(spark, sf), given.users(spark, sf), given.provinces(spark, sf), given.AS_OF
    )


def order_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Cheap lines name an order that does not exist."""
    lines = given.lines(spark, sf)
    lines = lines.withColumn(
        "order_id",
        F.when(F.col("order_price") < 5000, -1 - F.col("order_id")).otherwise(F.col("order_id")),
    )
    both = orders.pair(given.headers(spark, sf), lines, "full_outer")
    side = (
        F.when(F.col("line").isNull(), "header only")
        .when(F.col("header").isNull(), "line only")
        .otherwise("both")
    )
    return both.select(
        side.alias("side"),
        F.col("header.id").alias("header_id"),
        "header.total_amount",
        F.col("line.id").alias("line_id"),
        "line.order_id",
        "line.sku_id",
        "line.order_price",
    )


def _wide(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    return orders.order_wide(
        given.headers(spark, sf),
        lines,
        given.users(spark, sf),
        given.provinces(spark, sf),
        given.AS_OF,
    )


def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf, given.lines(spark, sf))


def order_late(spark: SparkSession, sf: str) -> DataFrame:
    pairs = orders.pair(given.header_arrivals(spark, sf), given.line_arrivals(spark, sf))
    near = orders.within_lifetime(pairs)
    return near.select(
        F.col("line.id").alias("detail_id"),
        F.col("header.id").alias("order_id"),
        F.col("line.sku_id").alias("sku_id"),
        F.col("line.order_price").alias("order_price"),
    )


def line_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Every line sent again once by a repeated read."""
    lines = given.lines(spark, sf)
    return orders.waiting_lines(lines.unionByName(lines))


# --- sinks ---

_WRITES = [
    "version",
    "sku_id",
    "order_price",
    "sku_num",
    "split_total_amount",
    "split_activity_amount",
    "split_coupon_amount",
    "create_time",
]


def sink_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Wide rows, then those of finished orders again with a new status."""
    path = shared_folder(spark) + "/order_wide"
    wide = orders.with_wide_day(order_wide(spark, sf))
    # thousands of days, so a folder for each year
    first = wide.withColumn("version", F.lit(1)).withColumn("year", F.substring("dt", 1, 4))
    write_batch(first, "version-1", path, "year", shuffled=False)
    schema = plus(ORDER_WIDE, version=IntegerType(), dt=StringType(), year=StringType())
    # finished orders are found in the sink, not joined again
    finished = read_batches(spark, path, schema).where((F.col("batch") == "version-1") & (F.col("order_status") == "F"))
    second = finished.drop("batch").withColumns({"order_status": F.lit("S"), "version": F.lit(2)})
    write_batch(second, "version-2", path, "year", shuffled=False)
    needed = ["dt", "detail_id", "order_id", "sku_id", "order_status", "version", "order_price", "user_id"]
    return read_latest(spark, path, schema, ["dt", "detail_id"], _WRITES, needed).select(
        "dt",
        orders.document_id().alias("doc_id"),
        "order_id",
        "sku_id",
        "order_status",
        "version",
        "order_price",
        "user_id",
    )


def sink_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Stored per day by the sink itself, written twice as a repeated batch, read back."""
    path = shared_folder(spark) + "/order_wide"
    wide = orders.with_wide_day(_wide(spark, sf, given.line_arrivals(spark, sf).drop("at")))
    write_batch(wide, "first", path, "dt", shuffled=False)
    schema = plus(ORDER_WIDE, dt=StringType())
    # the repeat finds its rows in the sink: they are neither joined again nor kept beside it
    again = read_batches(spark, path, schema).where(F.col("batch") == "first").drop("batch")
    write_batch(again, "first", path, "dt", shuffled=False)
    needed = ["dt", "detail_id", "order_id", "sku_id", "sku_num", "order_price", "user_age", "province_name"]
    return read_latest(spark, path, schema, ["dt", "detail_id"], _WRITES[1:], needed)


def end_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return end_offsets_of(given.app_log(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        json_field,
        json_typed,
        json_round_trip,
        dt_hr,
        create_date_hour,
        age_years,
        cdc_op_map,
        cdc_fact_route,
        cdc_fact_payload,
        json_whole_text,
        cdc_dim_rows,
        cdc_dim_latest,
        cdc_dim_drop,
        log_error_split,
        log_rejected,
        log_page,
        log_display,
        log_action,
        log_start,
        log_fanout,
        dau_entry,
        dau_dedup,
        dau_bad_time,
        dau_wide,
        dau_restore,
        order_enrich,
        order_outer,
        order_wide,
        order_late,
        line_distinct,
        sink_upsert,
        sink_by_day,
        end_offsets,
    )
}
