"""What keeps the order streams in proportion on large tables."""

from messages import Topic, finish
from test_large import messages, plan, rows

from millrace.operators import orders
from millrace.plans import stream_queries
from millrace.schemas import MESSAGE
from millrace.session import shared_folder
from millrace.sinks.batches import write_batch
from millrace.sources.streams import message_stream
from millrace.streaming import jobs

LINE = '{"id":%s,"order_id":%s,"sku_name":%s}'
TEXTS = [LINE % (1, 1, '"a"'), LINE % ('"2"', '"1"', "null"), LINE % ("null", 1, "2"), LINE % (1, '"x"', "2"), LINE % (1, 1.5, "{}"), LINE % (1, 1, '{"a":}'),
         LINE % (1, 1, '"a'), LINE % (1, 1, "[1,2"), LINE % (1, 1, 2) + " x", LINE % (1, 1, 2) + LINE % (1, 1, 2), '{"id":1}', "[]", "junk", "", None]


def test_rejects_make_no_other_field(spark):
    for parse, rejected in ((orders.parse_headers, orders.rejected_headers), (orders.parse_lines, orders.rejected_lines)):
        given = messages(spark, TEXTS)
        found = rejected(given)
        assert rows(found) == rows(parse(given).where("rejected").select(*given.columns)) and 0 < found.count() < len(TEXTS)
        assert "sku_name" not in plan(found) and "user_id" not in plan(found)


def test_days_that_were_never_closed_are_read_without_a_join(spark):
    days = jobs.Warehouse(shared_folder(spark)).order_days
    whole = [f.name for f in days.schema if f.name not in ("dt", "detail_id", "sku_id", "line_at")]
    given = spark.createDataFrame([("d", 1, 1, 1), ("d", 1, 2, 2), (None, 2, 1, 1)], "dt string, detail_id long, sku_id long, s long")
    given = given.selectExpr("dt", "detail_id", "sku_id", "timestamp_seconds(s) AS line_at", *[f"CAST(NULL AS {days.schema[c].dataType.simpleString()}) AS {c}" for c in whole])
    write_batch(given, "b", days.path, "dt")
    current = days.current(spark)
    assert rows(current.select("dt", "detail_id", "sku_id")) == [("d", 1, 2), (None, 2, 1)]
    assert "Join" not in plan(current) and "LogicalRDD" not in plan(current)


def test_files_of_a_batch_grow_with_the_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "FILES", 2)
    given = messages(spark, [str(i) for i in range(4000)])
    stream_queries._stored(spark, given, f"{tmp_path}/m", given["offset"] % stream_queries.BATCHES)
    stored = spark.read.schema(MESSAGE).parquet(f"{tmp_path}/m")
    assert len(stored.inputFiles()) == stream_queries.BATCHES * spark.sparkContext.defaultParallelism
    assert sorted(r.offset for r in stored.collect()) == list(range(4000))


def test_pairs_need_no_batch_without_rows(spark):
    at = jobs.Warehouse(shared_folder(spark))
    h, d = Topic(spark, at.root + "/h"), Topic(spark, at.root + "/d")
    h.send([{"id": 1, "create_time": "2024-01-01 00:00:00"}])
    d.send([{"id": 11, "order_id": 1}])
    started = jobs.widen_orders(message_stream(spark, h.path), message_stream(spark, d.path), at, trigger={"availableNow": True})
    finish(started)
    assert [p["numInputRows"] for p in started[0].recentProgress] == [2]
    assert [r.detail_id for r in jobs.order_wide_rows(spark, at).collect()] == [11]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
