"""The engine's inputs, derived by Spark from the star-schema test tables.

Every derivation covers its whole table. Values that a table lacks (hours,
birthdays, arrival times) are computed from columns of the same row.
"""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.parse import json_text
from millrace.sources.tables import table

AS_OF = datetime.date(2024, 12, 31)


def text(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _later(col: str, seconds: Column) -> Column:
    return F.col(col).cast("timestamp") + F.make_dt_interval(secs=seconds)


def _time_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def users(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as users: some without gender, some with a birthday that is no date."""
    segment = F.col("c_mktsegment")
    birthday = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return table(spark, sf, "customer").select(
        text("c_custkey").alias("id"),
        F.when(segment.isin("MACHINERY", "AUTOMOBILE"), "M")
        .when(segment.isin("FURNITURE", "HOUSEHOLD"), "F")
        .alias("gender"),
        F.when(F.col("c_acctbal") < -900, "unknown").otherwise(text(birthday)).alias("birthday"),
    )


def provinces(spark: SparkSession, sf: str) -> DataFrame:
    key = text("n_nationkey")
    return table(spark, sf, "nation").select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("ISO-"), key).alias("iso_code"),
        F.concat(F.lit("R"), text("n_regionkey"), F.lit("-"), key).alias("iso_3166_2"),
        F.lpad(text(F.col("n_nationkey") * 10), 6, "0").alias("area_code"),
    )


def headers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as headers. Some belong to no user, some to a user or province
    that no dimension row describes."""
    created = _later("o_orderdate", F.col("o_orderkey") * 7919 % 86400)
    later = lambda **span: _time_text(created + F.make_dt_interval(**{k: F.lit(v) for k, v in span.items()}))
    pending = F.col("o_orderstatus") == "P"
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        text(F.col("o_custkey") % 27).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(pending & (F.col("o_orderpriority") == "5-LOW"), "guest")
        .when(~(pending & (F.col("o_orderpriority") == "4-NOT SPECIFIED")), text("o_custkey"))
        .alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        (F.col("o_totalprice") * 0.125).alias("activity_reduce_amount"),
        (F.col("o_totalprice") * 0.0625).alias("coupon_reduce_amount"),
        (F.col("o_totalprice") * 1.25).alias("original_total_amount"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 20.0).otherwise(8.5).alias("freight_fee"),
        F.lit(0.0).alias("freight_fee_reduce"),
        later(mins=15).alias("expire_time"),
        later(days=7).alias("refundable_time"),
        _time_text(created).alias("create_time"),
        F.when(F.col("o_orderstatus") == "F", later(days=1)).alias("operate_time"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as order lines. Line numbers repeat within an order, so one
    line id may arrive several times with other values."""
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        price.alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku_"), text("l_partkey")).alias("sku_name"),
        _time_text(F.col("l_shipdate").cast("timestamp")).alias("create_time"),
        (price * (1 - F.col("l_discount"))).alias("split_total_amount"),
        (price * F.col("l_discount")).alias("split_activity_amount"),
        F.col("l_tax").alias("split_coupon_amount"),
    )


def _as_record(df: DataFrame) -> Column:
    return json_text(*df.columns)


def app_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw app logs. Signups start the app, some showing a page too;
    views show displays, clicks take actions, purchases do both; errors carry a
    page that must not count. Some lack their time, some are broken text."""
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k")
    events = (
        table(spark, sf, "events")
        .withColumn("k", _k())
        .withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    )
    common = F.struct(
        text(k % 27).alias("ar"),
        F.when(value >= 4, text("user_id")).when(value >= 2, F.lit("guest")).alias("uid"),
        F.concat(F.lit("os "), text(k % 3)).alias("os"),
        kind.alias("ch"),
        F.when(value > 50, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("model "), text(k % 10)).alias("md"),
        F.concat(F.lit("mid_"), text("user_id")).alias("mid"),
        F.lit("v2.1").alias("vc"),
        F.concat(F.lit("brand "), text(k % 5)).alias("ba"),
    )
    page = F.struct(
        F.when(kind == "click", "good_detail").when(kind == "purchase", "payment").otherwise("home").alias("page_id"),
        text(k).alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.floor(value * 100).alias("during_time"),
        F.when(kind == "purchase", "").when(kind.isin("click", "error"), "home").alias("last_page_id"),
        F.when(k < 50, "promotion").otherwise("query").alias("source_type"),
    )

    def numbered(size: Column, made) -> Column:
        return F.transform(F.sequence(F.lit(0), size), lambda i: F.when(i > 0, made(i)))

    displays = numbered(
        k % 4,
        lambda i: F.struct(
            F.when(i % 2 == 1, "query").otherwise("promotion").alias("display_type"),
            text(k + i).alias("item"),
            F.lit("sku_id").alias("item_type"),
            text(i).alias("pos_id"),
            text(i).alias("order"),
        ),
    )
    actions = numbered(
        k % 3,
        lambda i: F.struct(
            F.concat(F.lit("action_"), text(i)).alias("action_id"),
            text(k).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (F.col("ms") + i * 100).alias("ts"),
        ),
    )
    start = F.struct(
        F.lit("icon").alias("entry"),
        (k * 10).alias("loading_time"),
        text(k).alias("open_ad_id"),
        (k * 20).alias("open_ad_ms"),
        F.when(k >= 50, k).alias("open_ad_skip_ms"),
    )
    record = json_text(
        common.alias("common"),
        F.when((kind != "signup") | (value < 50), page).alias("page"),
        F.when(kind.isin("view", "purchase"), displays).alias("display"),
        F.when(kind.isin("click", "purchase"), actions).alias("actions"),
        F.when(kind == "signup", start).alias("start"),
        F.when(kind == "error", F.struct(k.alias("error_code"))).alias("err"),
        F.when((kind != "view") | (value <= 150), F.col("ms")).alias("ts"),
    )
    broken = (kind == "purchase") & (value > 200)
    return events.select(
        F.lit("ODS_BASE_LOG").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.when(broken, F.concat(F.lit("{"), record)).otherwise(record).alias("value"),
    )


def _envelope(df: DataFrame, table_name: str, change_type: Column, data: DataFrame | None = None) -> DataFrame:
    return df.select(
        F.concat(
            F.lit('{"type":'),
            F.coalesce(F.concat(F.lit('"'), change_type, F.lit('"')), F.lit("null")),
            F.lit(f',"table":"{table_name}","data":'),
            _as_record(df),
            F.lit("}"),
        ).alias("value"),
    )


def _change_type(col: str, names: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for value, name in names.items():
        chosen = F.when(F.col(col) == value, name).otherwise(chosen)
    return chosen


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change records of orders, lines, users, provinces and suppliers. Pending
    orders carry a type that is no row change; suppliers are in no list."""
    suppliers = table(spark, sf, "supplier").select(text("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    parts = [
        _envelope(
            headers(spark, sf),
            "order_info",
            _change_type("order_status", {"O": "insert", "F": "update", "P": "bootstrap-start"}),
        ),
        _envelope(
            lines(spark, sf).withColumn("price_band", (F.col("order_price") > 50000).cast("string")),
            "order_detail",
            _change_type("price_band", {"true": "bootstrap-insert"}),
        ),
        _envelope(users(spark, sf), "user_info", _change_type("gender", {"M": "insert", "F": "delete"})),
        _envelope(provinces(spark, sf), "base_province", F.lit("bootstrap-insert")),
        _envelope(suppliers, "supplier_info", F.lit("insert")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select(
        F.lit("ODS_BASE_DB").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        "value",
    )


def _orders_as_messages(spark: SparkSession, sf: str, value: Column) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.lit("ODS_BASE_DB").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("o_orderkey").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
    )


def exact_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as inserts whose amounts have 29 digits."""
    key = text("o_orderkey")
    return _orders_as_messages(
        spark,
        sf,
        F.concat(
            F.lit('{"type":"insert","table":"order_info","data":{"id":'),
            key,
            F.lit(',"amount":12345678901234567890.'),
            F.lpad(text(F.col("o_orderkey") % 1_000_000_000), 9, "0"),
            F.lit(',"note":"a ]} of '),
            key,
            F.lit('","parts":[{"n":1},{"n":'),
            key,
            F.lit("}]}}"),
        ),
    )


def trailed_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as inserts; behind each fifth stands something that isn't part of it."""
    key = text("o_orderkey")
    own = F.concat(F.lit('{"type":"insert","table":"order_info","data":{"id":'), key, F.lit("}}"))
    ends = [own, F.lit(" junk"), F.lit("],[{}"), F.lit(",")]
    behind = F.element_at(F.array(*ends), (F.floor(F.col("o_orderkey") / 5) % len(ends) + 1).cast("int"))
    whole = F.when(F.col("o_orderkey") % 5 == 0, F.concat(own, behind)).otherwise(F.concat(own, F.lit(" \n")))
    return _orders_as_messages(spark, sf, whole)


def odd_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as entry pages; some devices' clocks tell micro- or nanoseconds."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    factor = F.when(F.col("event_id") % 7 == 0, 1000).when(F.col("event_id") % 11 == 0, 1_000_000).otherwise(1)
    record = json_text(F.concat(F.lit("mid_"), text("user_id")).alias("mid"), (ms * factor).alias("ts"))
    return table(spark, sf, "events").select(
        F.lit("DWD_PAGE_LOG_TOPIC").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        record.alias("value"),
    )


# Provinces are in both lists.
FACT_TABLES = ["order_info", "order_detail", "base_province"]
DIM_TABLES = ["user_info", "base_province"]


def names(spark: SparkSession, tables: list[str]) -> DataFrame:
    """A list whose few bytes Spark knows, so that it is broadcast and no change shuffles."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table"))


def user_versions(spark: SparkSession, sf: str) -> DataFrame:
    """One to three change records per user, arriving out of their own order."""
    version = F.col("version")
    each = table(spark, sf, "customer").withColumn(
        "version", F.explode(F.sequence(F.lit(1), F.col("c_nationkey") % 3 + 1))
    )
    rank = version * (F.col("c_custkey") % 5 + 1) % 7
    data = json_text(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("g"), text("version")).alias("gender"),
        F.col("c_name").alias("birthday"),
    )
    kind = F.when(version == 1, "insert").when(version == 2, "update").otherwise("delete")
    return each.select(
        F.lit("ODS_BASE_DB").alias("topic"),
        F.lit(0).alias("partition"),
        rank.cast("bigint").alias("offset"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=rank)).alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.concat(
            F.lit('{"type":"'), kind, F.lit('","table":"user_info","data":'), data, F.lit("}")
        ).alias("value"),
    )


def header_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 7919 % 259200)
    return headers(spark, sf).withColumn("at", at)


def line_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Lines, created as they arrive, over three days."""
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("sku_id") * 104729 % 259200)
    return lines(spark, sf).withColumn("at", at).withColumn("create_time", _time_text(F.col("at")))
