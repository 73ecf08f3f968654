"""The four always-on jobs. Each takes streams of messages, from files or from
Kafka alike, and starts its queries. A query restarted on its checkpoint goes
on where it stopped; what a crashed batch left behind, its repeat replaces."""

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType, TimestampType

from millrace.functions.parse import json_text
from millrace.operators import cdc, dau, log_split, orders
from millrace.operators.keyed import highest_per_key
from millrace.schemas import DAU_INFO, DIMENSION_ROW, MESSAGE, STORED_ORDER_WIDE
from millrace.session import settings
from millrace.sinks.batches import batch_name, write_batch
from millrace.sinks.current import BUCKETS, read_current, write_current
from millrace.sinks.days import DayTable
from millrace.sinks.routes import as_messages, batch_to_kafka, route_to_files, route_to_kafka
from millrace.sources.tables import read_or_empty, table_list
from millrace.streaming.joins import fresh_of_day, stream_first_of_day, stream_pairs
from millrace.streaming.positions import observed
from millrace.streaming.state import ONLY_HEADER, ONLY_LINE, PAIR, order_sets

Trigger = Mapping[str, object]
EVERY_5_SECONDS: Trigger = {"processingTime": "5 seconds"}

ARRIVAL = cdc.ARRIVAL
# Order of the versions of a wide row; of two that arrived together the content decides,
# so that every run keeps the same one.
WIDE_ARRIVAL = ["header_at", "line_at"]
# Days of a batch that are read one by one.
UNMATCHED_HEADERS, UNMATCHED_LINES = "UNMATCHED_ORDER_INFO", "UNMATCHED_ORDER_DETAIL"
MANY_DAYS = 1_000
WIDE_ORDER = [*WIDE_ARRIVAL, "order_price", "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount"]


@dataclass(frozen=True)
class Warehouse:
    """Folders of one warehouse under a root that all executors share."""

    root: str
    # Of each dimension table; see sinks/current.py.
    buckets: int = BUCKETS

    @property
    def routes(self) -> str:
        """Routed messages, by topic."""
        return f"{self.root}/routes"

    @property
    def log_routes(self) -> str:
        """Routed app logs. Their stream keeps a list of the files that count in
        this folder, which makes each row appear once. It belongs to one
        checkpoint: a new checkpoint needs a new folder."""
        return f"{self.root}/log_routes"

    @property
    def dimensions(self) -> str:
        return f"{self.root}/dimensions"

    @property
    def fact_tables(self) -> str:
        return f"{self.root}/control/fact_tables"

    @property
    def dim_tables(self) -> str:
        return f"{self.root}/control/dim_tables"

    @property
    def dau_info(self) -> str:
        return f"{self.root}/dau_info"

    @property
    def order_wide(self) -> str:
        return f"{self.root}/order_wide"

    @property
    def dau_days(self) -> DayTable:
        """The wide row of each device and day: the first, should it be stored twice."""
        order = ["ts", *(c for c in DAU_INFO.fieldNames() if c not in (*dau.KEY, "ts"))]
        return DayTable(self.dau_info, DAU_INFO, dau.KEY, order, first=True)

    @property
    def order_days(self) -> DayTable:
        """The wide row of each line and day, as last written."""
        return DayTable(self.order_wide, STORED_ORDER_WIDE, ["dt", "detail_id"], WIDE_ORDER)

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected"

    @property
    def unmatched(self) -> str:
        """Headers without a line and lines without a header, as messages by topic."""
        return f"{self.root}/unmatched"

    @property
    def positions(self) -> str:
        """What the jobs have worked off; see streaming/positions.py."""
        return f"{self.root}/positions"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"


def _start(writer: DataStreamWriter, name: str, trigger: Trigger) -> StreamingQuery:
    return writer.queryName(name).trigger(**trigger).start()


# For a query from whose state rows come only when others are read: without this, each batch
# is followed by another that looks through the whole state and finds nothing to tell. What
# is too old goes with the next batch that has rows.
ROWS_ALONE = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def _each_batch(stream: DataFrame, work, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)


# --- current state of the tables ---


def _versions(spark: SparkSession, at: Warehouse, table: str) -> DataFrame:
    return read_current(spark, at.dimensions, DIMENSION_ROW, "table", table)


def keep_dimensions(rows: DataFrame, at: Warehouse) -> None:
    """Merges versions of dimension rows into the table of current ones."""
    write_current(rows, at.dimensions, DIMENSION_ROW, "table", ["table", "id"], ARRIVAL, at.buckets)


def dimensions(spark: SparkSession, at: Warehouse, on_delete: str = "keep") -> tuple[DataFrame, DataFrame]:
    """Users and provinces as they are now."""
    users = cdc.current_rows(_versions(spark, at, "user_info"), on_delete)
    provinces = cdc.current_rows(_versions(spark, at, "base_province"), on_delete)
    return cdc.user_info(users), cdc.base_province(provinces)


def dimensions_for(facts: DataFrame, at: Warehouse, on_delete: str = "keep") -> tuple[DataFrame, DataFrame]:
    """Both dimensions as they are now, as far as a batch of facts refers to them: the
    buckets of the batch's ids are read, and no others."""

    def needed(table: str, key: str) -> DataFrame:
        ids = facts.select(F.col(key).alias("id")).where("id IS NOT NULL")
        versions = read_current(facts.sparkSession, at.dimensions, DIMENSION_ROW, "table", table, ids)
        return cdc.current_rows(versions, on_delete)

    return (
        cdc.user_info(needed("user_info", "user_id")),
        cdc.base_province(needed("base_province", "province_id")),
    )


def dau_rows(spark: SparkSession, at: Warehouse) -> DataFrame:
    """The wide row of each device and day."""
    return at.dau_days.current(spark)


def order_wide_rows(spark: SparkSession, at: Warehouse) -> DataFrame:
    """The wide row of each line and day, as last written."""
    return at.order_days.current(spark).drop(*WIDE_ARRIVAL)


# --- jobs ---


def split_logs(
    messages: DataFrame,
    at: Warehouse,
    trigger: Trigger = EVERY_5_SECONDS,
    servers: str | None = None,
) -> list[StreamingQuery]:
    """Raw app logs to their five routes, and what cannot be read to a sixth:
    topics of the Kafka ``servers`` when given, else folders."""
    routed = log_split.fan_out(log_split.parse_log(observed(messages)), *ARRIVAL)
    name = "split_logs"
    if servers:
        writer = route_to_kafka(routed, servers, at.checkpoint(name))
    else:
        writer = route_to_files(routed, at.log_routes, at.checkpoint(name))
    return [_start(writer, name, trigger)]


def split_changes(
    messages: DataFrame,
    at: Warehouse,
    trigger: Trigger = EVERY_5_SECONDS,
    servers: str | None = None,
) -> list[StreamingQuery]:
    """Change records to fact routes, as for logs, and to dimension rows, by the
    table lists as they stand at each batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        facts = table_list(spark, at.fact_tables)
        dims = table_list(spark, at.dim_tables)
        name = batch_name(spark, batch_id)
        # the texts are read twice rather than kept: a second look at type and table
        # costs less than to store all records of a batch
        routed = cdc.routed_messages(cdc.parse_changes(batch), facts, dims, *ARRIVAL)
        if servers:
            batch_to_kafka(routed, servers)
        else:
            write_batch(as_messages(routed), name, at.routes, "topic")
        rows = cdc.dimension_rows(cdc.parse_changes(batch, dims), dims).persist()
        try:
            keep_dimensions(rows, at)
        finally:
            rows.unpersist()

    name = "split_changes"
    return [_start(_each_batch(observed(messages), work, at.checkpoint(name)), name, trigger)]


def daily_actives(
    messages: DataFrame,
    at: Warehouse,
    as_of: date | Column | None = None,
    seen: str = "state",
    restore: bool = True,
    on_delete: str = "keep",
    trigger: Trigger = EVERY_5_SECONDS,
    lifetime: str = "24 hours",
    clock: Column | None = None,
) -> list[StreamingQuery]:
    """Page messages to the daily-active table, the first to arrive of each device and day.

    ``seen="state"`` keeps the devices of a day in the state store for ``lifetime`` after
    they were last read, twice that at most; a batch costs its own rows. The state of a
    new checkpoint is not whole before that time has passed: with ``restore`` its batches
    are compared with the table until then, as a start over an older table must. Should a
    device come back when its state is gone, ``dau_rows`` gives its first row.
    ``seen="table"`` asks the table in each batch, and needs no state. Of the table only
    the days of a batch are listed and read.

    Of the rows of one batch that with the smallest time of arrival, partition and offset
    is the first. Messages that can't be used go with the same read to a rejected folder.
    They pass the state as days of their own, one for each partition and offset. ``clock``
    tells time for the state, one moment for each batch.
    """
    if seen not in ("table", "state"):
        raise ValueError(f"seen must be table or state, not {seen!r}")
    entries = dau.entries_or_rejected(dau.parse_pages(observed(messages)))
    columns = entries.columns

    def widen(firsts: DataFrame, name: str, compare: bool) -> None:
        fresh = firsts
        if compare:
            stored = at.dau_days.rows(firsts.sparkSession, _days(firsts), without=name)
            fresh = dau.not_yet_stored(firsts, stored)
        fresh = fresh.persist()
        try:
            if fresh.isEmpty():
                return
            missed = Observation()
            users, provinces = dimensions_for(fresh, at, on_delete)
            write_batch(dau.dau_info(fresh, users, provinces, as_of, misses=missed), name, at.dau_info, "dt")
            report("daily_actives", name, missed)
        finally:
            fresh.unpersist()

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = batch_name(spark, batch_id)
        batch = batch.persist()
        try:
            rows = batch if seen == "table" else fresh_of_day(batch, columns, lifetime)
            write_rejected(rows.where("rejected"), name, at, "daily_actives")
            firsts = rows.where("NOT rejected")
            if seen == "table":
                firsts = dau.first_of_day(firsts, ARRIVAL)
            widen(firsts, name, seen == "table" or (restore and _restoring(spark, at, batch, name, lifetime)))
        finally:
            batch.unpersist()

    name = "daily_actives"
    if seen == "table":
        writer = _each_batch(entries, work, at.checkpoint(name))
    else:
        writer = _each_batch(stream_first_of_day(entries, ARRIVAL, lifetime, clock), work, at.checkpoint(name), "update")
    return [_start(writer, name, trigger)]


def _restoring(spark: SparkSession, at: Warehouse, batch: DataFrame, name: str, lifetime: str) -> bool:
    """Whether the state of a query is younger than what it should remember.

    The moment until which it is, is written with the query's first batch that has rows,
    under the query's own id. A repeat of that batch finds it and is compared as well.
    """
    now = batch.agg(F.max("last_read")).first()[0]
    if now is None:
        return False
    path = f"{at.root}/restored/{name.rpartition('-')[0]}"
    born = read_or_empty(spark, path, StructType().add("until", TimestampType())).first()
    if born is None:
        until = spark.range(1).select((F.lit(now) + F.expr(f"interval {lifetime}")).alias("until"))
        until.coalesce(1).write.mode("overwrite").parquet(path)
        return True
    return now <= born["until"]


def _days(firsts: DataFrame) -> list[str] | None:
    """The days of a batch, or null for all days where a batch names very many."""
    days = [r[0] for r in firsts.select("dt").distinct().limit(MANY_DAYS + 1).collect()]
    return sorted(days) if len(days) <= MANY_DAYS else None


def widen_orders(
    header_messages: DataFrame,
    line_messages: DataFrame,
    at: Warehouse,
    as_of: date | Column | None = None,
    lifetime: str = orders.LIFETIME,
    salts: int = 1,
    on_delete: str = "keep",
    trigger: Trigger = EVERY_5_SECONDS,
    waiting: str = "join",
    unmatched: bool = False,
    apart: str | None = None,
    replay: bool = False,
) -> list[StreamingQuery]:
    """Header and line messages to the order wide table, by line and day.

    ``waiting="join"`` joins the streams: partners that arrive up to ``lifetime`` apart
    meet, and each row waits on its own. ``unmatched`` makes that a full outer join: what
    waits in vain goes to the unmatched folder when its life ends and something later has
    been read. ``waiting="sets"`` keeps the lines of an order as a set that lives for
    ``lifetime`` after its last line, and always tells what was unmatched; ``apart`` limits
    there how far apart partners may have arrived. ``replay`` lets arrivals tell time, not
    the clock.
    """
    if waiting not in ("join", "sets"):
        raise ValueError(f"waiting must be join or sets, not {waiting!r}")

    def work(found: DataFrame, batch_id: int) -> None:
        name = batch_name(found.sparkSession, batch_id)
        found = found.persist()
        try:
            if waiting == "sets" or unmatched:
                write_batch(_unmatched(found), name, at.unmatched, "topic")
                widen(found.where(F.col("kind") == PAIR).drop("kind"), name)
            else:
                widen(found, name)
        finally:
            found.unpersist()

    def widen(pairs: DataFrame, name: str) -> None:
        if pairs.isEmpty():
            return
        missed = Observation()
        users, provinces = dimensions_for(pairs.select("header.*"), at, on_delete)
        wide = orders.merge(
            orders.enrich_pairs(pairs, users, provinces, as_of, misses=missed),
            F.col("header.at").alias("header_at"),
            F.col("line.at").alias("line_at"),
        )
        latest = highest_per_key(orders.with_wide_day(wide), ["dt", "detail_id"], WIDE_ORDER)
        write_batch(latest, name, at.order_wide, "dt")
        report("widen_orders", name, missed)

    arrival = F.col("timestamp").alias("at")
    headers = orders.headers_of(orders.parse_headers(observed(header_messages, 0)), arrival)
    lines = orders.lines_of(orders.parse_lines(observed(line_messages, 1)), arrival)
    if waiting == "sets":
        source = order_sets(headers, lines, lifetime, apart, replay)
    elif unmatched:
        kind = F.when(F.col("line").isNull(), ONLY_HEADER).when(F.col("header").isNull(), ONLY_LINE).otherwise(PAIR)
        source = stream_pairs(headers, lines, lifetime, 1, "full_outer", replay).withColumn("kind", kind)
    else:
        source = stream_pairs(headers, lines, lifetime, salts, replay=replay)
    columns = MESSAGE.fieldNames()
    rejects = orders.rejected_headers(header_messages).select(*columns).unionByName(orders.rejected_lines(line_messages).select(*columns))
    name = "widen_orders"
    with settings(source.sparkSession, ROWS_ALONE if waiting == "join" and not unmatched else {}):
        pairing = _start(_each_batch(source, work, at.checkpoint(name)), name, trigger)
    return [pairing, keep_rejected(rejects, at, name, trigger)]


def _unmatched(found: DataFrame) -> DataFrame:
    """Rows that were left alone, as messages of a topic for each side."""
    parts = []
    for kind, topic in ((ONLY_HEADER, UNMATCHED_HEADERS), (ONLY_LINE, UNMATCHED_LINES)):
        side = found.where(F.col("kind") == kind).select(f"{kind}.*")
        fields = [c for c in side.columns if c != "at"]
        key = F.col("id" if kind == ONLY_HEADER else "order_id").cast("string")
        parts.append(
            side.select(F.lit(topic).alias("topic"), F.col("at").alias("timestamp"), key.alias("key"), json_text(*fields).alias("value"))
        )
    return as_messages(parts[0].unionByName(parts[1]))


def write_rejected(rows: DataFrame, batch: str, at: Warehouse, job: str) -> None:
    """Messages of a batch that a job could not use, as they came."""
    write_batch(rows.select(*MESSAGE.fieldNames()), batch, f"{at.rejected}/{job}", "topic")


def keep_rejected(rows: DataFrame, at: Warehouse, job: str, trigger: Trigger) -> StreamingQuery:
    """As ``write_rejected``, by a query of its own: what a join of streams drops can't
    be told from its output, so its inputs are read once more."""
    name = f"{job}_rejected"
    writer = route_to_files(rows, f"{at.rejected}/{job}", at.checkpoint(name))
    return _start(writer, name, trigger)


def report(job: str, batch: str, missed: Observation) -> None:
    """Logs the facts of a batch that met no dimension row; an empty batch has none."""
    counts = missed.get
    if any(counts.values()):
        logging.getLogger(__name__).warning("%s, batch %s: %s", job, batch, counts)
