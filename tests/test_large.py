"""What keeps the work in proportion on large tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from millrace.functions.parse import with_json
from millrace.operators import cdc
from millrace.plans import standins, stream_queries
from millrace.schemas import MESSAGE

RECORD = '{"type":"%s","table":"%s","data":{"id":%s,"x":1.50}}'
TEXTS = [RECORD % ("insert", "a", 1), RECORD % ("delete", "b", 2), RECORD % ("bootstrap-start", "a", 3), RECORD % ("update", "c", 4),
         RECORD % ("insert", "b", "null"), RECORD % ("insert", "a", 5) + "x", "junk", None, '{"type":"insert","data":{"id":1}}']


def messages(spark, texts=TEXTS):
    rows = [(t, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, offset long").selectExpr(
        "'t' AS topic", "0 AS partition", "offset", "TIMESTAMP'2024-01-01' AS timestamp", "CAST(NULL AS STRING) AS key", "value"
    )


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_listed_changes_alone(spark):
    only = standins.names(spark, ["a", "b"])
    every = cdc.in_tables(cdc.known_changes(cdc.parse_changes(messages(spark))), only)
    some = cdc.parse_changes(messages(spark), only)
    assert rows(some.select(*every.columns)) == rows(every) and some.count() == 3


def test_routes_in_one_pass(spark):
    changes, facts, dims = cdc.parse_changes(messages(spark)), standins.names(spark, ["a", "b"]), standins.names(spark, ["b", "c"])
    apart = cdc.fact_messages(changes, facts, "offset").unionByName(cdc.rejected_messages(changes, dims, "offset"))
    at_once = cdc.routed_messages(changes, facts, dims, "offset")
    assert rows(at_once) == rows(apart) and at_once.count() == 7
    assert plan(at_once).count("LogicalRDD") == 1


def test_list_is_known_to_be_small(spark):
    joined = cdc.in_tables(spark.range(9).select(F.col("id").cast("string").alias("table")), standins.names(spark, ["a"]))
    assert "SortMergeJoin" not in joined._jdf.queryExecution().sparkPlan().toString()


def test_filter_does_not_repeat_the_casts(spark):
    parsed = with_json(messages(spark), StructType().add("id", LongType()).add("n", LongType()))
    filters = [line for line in plan(parsed.where("j.id > 1 AND j.n > 1")).splitlines() if "Filter" in line]
    assert filters and not any("cast(" in line for line in filters)


def test_messages_are_stored_without_a_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", lambda *_: 1 / 0)
    given = messages(spark, [str(i) for i in range(4000)])
    stream_queries._stored(spark, given, f"{tmp_path}/m", F.col("offset") % stream_queries.BATCHES)
    stored = spark.read.schema(MESSAGE).parquet(f"{tmp_path}/m")
    assert sorted(r.offset for r in stored.collect()) == list(range(4000))
    assert len(stored.inputFiles()) == stream_queries.BATCHES * stream_queries.FILES
