"""Run one of the four jobs: ``python -m millrace.main JOB --root FOLDER``.

Reads from Kafka with ``--servers``, else from the message folders of the root.
``close_days`` folds the batches of past days of both wide tables, beside the running
jobs; with ``--tidy`` it also removes what is folded in.
"""

import argparse
import json
import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.log_split import PAGE_TOPIC
from millrace.session import tune
from millrace.sinks.current import buckets_for
from millrace.sources.streams import kafka_stream, message_stream
from millrace.streaming import jobs
from millrace.streaming.positions import StoredPositions, stored_positions
from millrace.streaming.progress import end_positions, rates

# The topics each job reads.
LOG_TOPIC = "ODS_BASE_LOG"
CHANGE_TOPIC = "ODS_BASE_DB"
HEADER_TOPIC = "DWD_ORDER_INFO_I"
LINE_TOPIC = "DWD_ORDER_DETAIL_I"

JOBS = ("split_logs", "split_changes", "daily_actives", "widen_orders")
CLOSE = "close_days"
STORED = "stored"


def start(
    spark: SparkSession,
    job: str,
    at: jobs.Warehouse,
    servers: str | None,
    trigger,
    positions: dict | None = None,
    on_delete: str = "keep",
    **how,
) -> list:
    """Starts a job's queries. ``positions`` maps topic to partition to first offset.

    ``how`` goes to the two jobs of wide tables, and is theirs to know.
    """

    def read(topic: str, folder: str) -> DataFrame:
        if servers:
            own = {topic: positions[topic]} if positions and topic in positions else None
            return kafka_stream(spark, servers, topic, own)
        return message_stream(spark, folder, topic=topic, replaced=folder == at.routes)

    if job == "split_logs":
        return jobs.split_logs(read(LOG_TOPIC, f"{at.root}/raw_log"), at, trigger, servers)
    if job == "split_changes":
        return jobs.split_changes(read(CHANGE_TOPIC, f"{at.root}/raw_db"), at, trigger, servers)
    if job == "daily_actives":
        return jobs.daily_actives(read(PAGE_TOPIC, at.log_routes), at, on_delete=on_delete, trigger=trigger, **how)
    headers, lines = read(HEADER_TOPIC, at.routes), read(LINE_TOPIC, at.routes)
    return jobs.widen_orders(headers, lines, at, on_delete=on_delete, trigger=trigger, **how)


def close_days(spark: SparkSession, at: jobs.Warehouse, before: str, tidy: bool = False) -> None:
    for table in (at.dau_days, at.order_days):
        table.close(spark, before)
        if tidy:
            table.tidy(spark)


def first_positions(spark: SparkSession, at: jobs.Warehouse, job: str, given: str | None) -> dict | None:
    """The positions to start a new checkpoint from: as given, or as an earlier run stored them."""
    if given != STORED:
        return json.loads(given) if given else None
    return stored_positions(spark, at.positions, job) or None


def wait(spark: SparkSession, started: list) -> None:
    """Returns when all queries have ended; stops them all and raises as soon as one fails."""
    try:
        while any(query.isActive for query in started):
            spark.streams.awaitAnyTermination(5)
            spark.streams.resetTerminated()
            for query in started:
                if query.lastProgress:
                    logging.info("%s read to %s: %s", query.name, end_positions(query), rates(query))
        for query in started:
            query.awaitTermination()
    except Exception:
        for query in started:
            query.stop()
        raise


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=(*JOBS, CLOSE))
    parser.add_argument("--root", required=True, help="folder that all executors share")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--every", default="5 seconds", help="micro-batch interval")
    parser.add_argument("--once", action="store_true", help="read what there is, then stop")
    parser.add_argument("--start", help='first offsets, as {"topic": {"0": 12}}, or "stored"')
    parser.add_argument("--on-delete", choices=("keep", "drop"), default="keep", help="deleted dimension rows")
    parser.add_argument("--buckets", type=int, help="buckets of a dimension table; by its bytes unless given")
    parser.add_argument("--waiting", choices=("join", "sets"), default="join", help="how lines wait for their order")
    parser.add_argument("--unmatched", action="store_true", help="tell orders and lines that found no partner")
    parser.add_argument("--before", help="days before this one are closed")
    parser.add_argument("--tidy", action="store_true", help="remove the batches of closed days")
    args = parser.parse_args()
    spark = tune(SparkSession.builder.appName(args.job).getOrCreate())
    at = jobs.Warehouse(args.root)
    if args.job == CLOSE:
        close_days(spark, at, args.before or date.today().isoformat(), args.tidy)
        return
    at = jobs.Warehouse(args.root, args.buckets or buckets_for(spark, at.dimensions))
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    how = {"waiting": args.waiting, "unmatched": args.unmatched} if args.job == "widen_orders" else {}
    positions = first_positions(spark, at, args.job, args.start)
    spark.streams.addListener(StoredPositions(spark, at.positions))
    wait(spark, start(spark, args.job, at, args.servers, trigger, positions, args.on_delete, **how))


if __name__ == "__main__":
    main()
