"""Hand fixtures for the edges, and the joins against brute force."""

import contextlib
import datetime as dt
import json
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.functions import exprs
from millrace.functions.parse import with_json
from millrace.operators import cdc, dau, keyed, log_split, orders, skew
from millrace.operators.enrich import with_user_and_province
from millrace.operators.keyed import latest_per_key
from millrace.schemas import APP_LOG, MESSAGE, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE
from millrace.session import shared_folder
from millrace.sinks import batches, current
from millrace.sources.streams import starting_offsets
from millrace.sources.tables import read_or_empty


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@contextlib.contextmanager
def settings(spark, changed):
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def one(df):
    (row,) = df.collect()
    return row


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- scalar functions ---


@pytest.mark.parametrize(
    "born, today, years",
    [
        ("2004-02-29", "2025-02-28", 20),
        ("2004-02-29", "2025-03-01", 21),
        ("2000-12-31", "2024-12-31", 24),
        ("2001-01-01", "2024-12-31", 23),
        ("2025-01-01", "2024-12-31", 0),
        ("2026-01-01", "2024-12-31", -1),
        ("not a date", "2024-12-31", None),
        (None, "2024-12-31", None),
    ],
)
def test_age_counts_completed_years(spark, born, today, years):
    df = spark.createDataFrame([(born,)], "b string")
    as_of = dt.date.fromisoformat(today)
    assert one(df.select(exprs.age_text(F.col("b"), as_of)))[0] == (None if years is None else str(years))


def test_dates_follow_the_session_zone(spark):
    def cut():
        df = spark.createDataFrame([(1704067199999,)], "ts bigint")
        return tuple(one(df.select(exprs.event_date(F.col("ts")), exprs.event_hour(F.col("ts")))))

    assert cut() == ("2023-12-31", "23")
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Shanghai"}):
        assert cut() == ("2024-01-01", "07")


def test_create_parts_of_odd_text(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02",), (None,)], "t string")
    rows = df.select(exprs.date_part(F.col("t")), exprs.hour_part(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("2024-01-02", "03"), ("2024-01-02", None), (None, None)]


def test_op_codes(spark):
    kinds = ["bootstrap-insert", "insert", "update", "delete", "bootstrap-start", "INSERT", None]
    df = spark.createDataFrame([(k,) for k in kinds], "t string")
    assert [r[0] for r in df.select(exprs.op_code(F.col("t"))).collect()] == ["I", "I", "U", "D", None, None, None]


# --- parsing ---


def test_numbers_may_be_quoted_or_fractional(spark):
    big = 9007199254740993
    df = with_json(values(spark, json.dumps({"ts": str(big)}), '{"ts": 1.5}', '{"ts": 1.7e12}', '{"ts": "x"}', "{}"), APP_LOG)
    assert [r[0] for r in df.select("j.ts").collect()] == [big, 1, 1700000000000, None, None]


def test_unreadable_text_gives_no_record(spark):
    whole = ["{} ", ' {"page": {"page_id": "]}"}}\n']
    broken = ["{", "", "[1]", "3", "null", None, '{"page": "text"}', "[{}]"]
    behind = ["{} junk", "{}{}", "{},{}", "{}]", "{}],[{}", '{},{"_end":"1"}]', "{}}", "junk {}"]
    df = with_json(values(spark, *whole, *broken, *behind), APP_LOG)
    assert [r.j is None for r in df.collect()] == [False] * 2 + [True] * 16


def test_missing_numbers_read_as_zero_but_ids_do_not(spark):
    parsed = orders.parse_lines(values(spark, '{"id": 1, "order_id": 2}', '{"id": 1}', "{"))
    assert [r.rejected for r in parsed.collect()] == [False, True, True]
    row = one(orders.lines_of(parsed))
    assert (row.order_price, row.sku_num, row.sku_name, row.split_total_amount) == (0.0, 0, None, 0.0)


# --- log split ---


def log(**parts):
    return json.dumps({"common": {"mid": "m", "uid": "1"}, "ts": 5, **parts})


PAGE = {"page_id": "home", "during_time": 7}


@pytest.mark.parametrize(
    "record, topics",
    [
        (log(page=PAGE), ["PAGE_LOG"]),
        (log(page=PAGE, display=[{"item": "1"}, {"item": "2"}], actions=[{"ts": 1}] * 3), ["PAGE_ACTION"] * 3 + ["PAGE_DISPLAY"] * 2 + ["PAGE_LOG"]),
        (log(page=PAGE, start={"entry": "icon"}), ["PAGE_LOG", "START_LOG"]),
        (log(start={"entry": "icon"}), ["START_LOG"]),
        (log(page=PAGE, err={"code": 1}), ["ERROR_LOG"]),
        (log(display=[{"item": "1"}]), []),
        (log(page=PAGE, display=[], actions=[None]), ["PAGE_LOG"]),
        (log(page=PAGE, ts=None), ["REJECTED"]),
        (json.dumps({"page": PAGE, "ts": 1}), ["REJECTED"]),
        (json.dumps({"err": {}}), ["ERROR_LOG"]),
        ("{", ["REJECTED"]),
    ],
)
def test_fan_out(spark, record, topics):
    parsed = log_split.parse_log(values(spark, record))
    got = sorted(r.topic for r in log_split.fan_out(parsed).collect())
    names = [t.replace("DWD_", "").replace("_TOPIC", "").replace("_BASE_LOG", "") for t in got]
    assert sorted(names) == topics
    branches = {
        log_split.PAGE_TOPIC: log_split.page_log,
        log_split.DISPLAY_TOPIC: log_split.display_log,
        log_split.ACTION_TOPIC: log_split.action_log,
        log_split.START_TOPIC: log_split.start_log,
        log_split.ERROR_TOPIC: log_split.error_log,
        log_split.REJECTED_TOPIC: log_split.rejected_log,
    }
    counts = {topic: branch(parsed).count() for topic, branch in branches.items()}
    assert {t: n for t, n in counts.items() if n} == {t: got.count(t) for t in set(got)}


def test_error_records_pass_unchanged(spark):
    text = '{"err": {"code": 1.50},  "ts": 1}'
    assert one(log_split.fan_out(log_split.parse_log(values(spark, text)))).value == text


def test_the_fan_out_reads_and_parses_its_input_once(spark):
    with settings(spark, {"spark.sql.debug.maxToStringFields": "1000"}):
        source = spark.range(3).select(F.format_string('{"ts": %d}', "id").alias("value"))
        plan = plan_of(log_split.fan_out(log_split.parse_log(source)))
    assert plan.count("from_json(") == 1
    assert plan.count("Range (") == 1


# --- keyed reductions ---


def random_rows(seed, n=400):
    rng = random.Random(seed)
    keys = ["hot"] * (n // 3) + [rng.choice("abcdefgh") for _ in range(n - n // 3)]
    return [(k, rng.randrange(50), i, rng.choice([None, "x", "y"])) for i, k in enumerate(keys)]


@pytest.mark.parametrize("seed", [1, 2])
def test_first_and_latest_per_key(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "k string, t int, i int, v string").repartition(7)
    first = {r.k: tuple(r) for r in keyed.first_per_key(df, ["k"], ["t", "i"]).collect()}
    last = {r.k: tuple(r) for r in keyed.latest_per_key(df, ["k"], ["t", "i"]).collect()}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        assert (first[k], last[k]) == (mine[0], mine[-1])


def test_keyed_reductions_reduce_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(keyed.first_per_key(df, ["k"], ["id"]))
    assert plan.index("min_by") < plan.index("Exchange") < plan.index("partial_min_by")


def test_end_offsets(spark):
    rows = [("t", 0, 5, None, None, None), ("t", 0, 9, None, None, None), ("t", 1, 0, None, None, None)]
    got = keyed.end_offsets(spark.createDataFrame(rows, MESSAGE)).collect()
    assert sorted(tuple(r) for r in got) == [("t", 0, 10), ("t", 1, 1)]
    assert json.loads(starting_offsets({"t": {0: 10, 1: 1}})) == {"t": {"0": 10, "1": 1}}


# --- joins under skew ---


def test_heavy_keys_finds_all_and_only_the_heavy(spark):
    rows = [("hot",)] * 700 + [(None,)] * 300 + [(f"k{i}",) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string").repartition(5)
    assert set(skew.heavy_keys(df, "k", 0.1)) == {"hot", None}
    assert skew.heavy_keys(df.where("k <> 'hot'"), "k", 0.1) == []
    assert skew.heavy_keys(df.limit(0), "k") == []


def brute(many, one, how):
    out = []
    for m in many:
        hits = [o for o in one if o[0] == m[0] and m[0] is not None]
        out += [m + o for o in hits] or ([m + (None, None)] if how == "left" else [])
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy", [None, [], ["hot"], ["hot", "a", None, "not there"]])
def test_skew_join_equals_a_plain_join(spark, how, heavy):
    many = [(r[0] if r[2] % 9 else None, r[2]) for r in random_rows(3)] + [("hot", -1)] * 50
    few = [("hot", "H"), ("a", "A1"), ("a", "A2"), ("b", "B"), ("zz", "Z")]
    left = spark.createDataFrame(many, "mk string, i int").repartition(5)
    right = spark.createDataFrame(few, "ok string, v string")
    got = skew.skew_join(left, right, "mk", "ok", how, heavy, salts=4)
    assert order(got.collect()) == order(brute(many, few, how))


def test_skew_join_spreads_a_heavy_key(spark):
    left = spark.range(4000).select(F.lit("hot").alias("mk"), "id").repartition(4)
    right = spark.createDataFrame([("hot", 1)], "ok string, v int")
    apart = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, apart):
        joined = skew.skew_join(left, right, "mk", "ok", heavy=["hot"], salts=64)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 4000
    assert max(r["count"] for r in parts) < 2000


def test_lookup_join(spark):
    many = [("a", 1), ("b", 2), (None, 3), ("z", 4)] + [("a", i) for i in range(10, 40)]
    few = [("a", "A"), ("b", "B")]
    got = skew.lookup_join(
        spark.createDataFrame(many, "mk string, i int"), spark.createDataFrame(few, "ok string, v string"), "mk", "ok"
    )
    assert order(got.collect()) == order(brute(many, few, "left"))


@pytest.mark.parametrize("heavy", [None, [], [1]])
def test_full_outer_pairs(spark, heavy):
    heads = [(1, "one"), (2, "none"), (3, "three"), (3, "again")]
    rows = [(10, 1)] * 20 + [(11, 3), (12, 9), (13, None)]
    h = spark.createDataFrame(heads, "id bigint, status string")
    d = spark.createDataFrame(rows, "id bigint, order_id bigint").repartition(3)
    got = orders.pair(h, d, "full_outer", heavy, salts=4).select("header.status", "line.id").collect()
    assert order(got) == order([("one", 10)] * 20 + [("three", 11), ("again", 11), (None, 12), (None, 13), ("none", None)])


# --- wide rows ---


def test_wide_rows_name_and_precedence(spark):
    h = spark.createDataFrame(
        [(1, "7", "1", "2024-01-01 10:00:00"), (2, "8", None, "2024-01-01 10:00:00")],
        "id bigint, province_id string, user_id string, create_time string",
    )
    for name in ORDER_INFO.fieldNames():
        if name not in h.columns:
            h = h.withColumn(name, F.lit(None).cast(ORDER_INFO[name].dataType))
    d = orders.lines_of(
        orders.parse_lines(values(spark, '{"id": 2, "order_id": 1}', '{"id": 3, "order_id": 2, "create_time": "2024-01-02 00:00:00"}'))
    )
    users = spark.createDataFrame([("1", "F", "2000-01-01")], "id string, gender string, birthday string")
    provinces = spark.createDataFrame([("7", "N", "n", "n-1", "07")], "id string, name string, iso_code string, iso_3166_2 string, area_code string")
    wide = orders.order_wide(h, d, users, provinces, dt.date(2024, 12, 31))
    assert wide.columns == ORDER_WIDE.fieldNames()
    got = {r.detail_id: r for r in orders.with_wide_day(wide).collect()}
    # line 2 belongs to order 1, though an order 2 exists
    assert (got[2].order_id, got[2].create_time, got[2].create_date, got[2].dt) == (1, None, "2024-01-01", "2024-01-01")
    assert (got[2].user_age, got[2].user_gender, got[2].province_3166_2_code) == ("24", "F", "n-1")
    assert (got[3].order_id, got[3].create_hour, got[3].dt, got[3].user_age, got[3].province_name) == (2, "10", "2024-01-02", None, None)


def test_waiting_lines_are_a_set(spark):
    d = orders.lines_of(orders.parse_lines(values(spark, *['{"id": 1, "order_id": 1, "sku_num": 2}'] * 3, '{"id": 1, "order_id": 1}')))
    assert orders.waiting_lines(d).count() == 2


def test_an_empty_previous_page_is_no_entry(spark):
    df = spark.createDataFrame([(None,), ("",), ("home",)], "last_page_id string")
    assert dau.entry_pages(df).count() == 1


def test_a_table_may_be_in_both_lists(spark):
    changes = cdc.parse_changes(
        spark.createDataFrame([("t", 0, 0, dt.datetime(2024, 1, 1), None, '{"type":"insert","table":"a","data":{"id":1}}')], MESSAGE)
    )
    names = spark.createDataFrame([("a",)], "table string")
    assert cdc.fact_messages(changes, names).count() == cdc.dimension_rows(changes, names).count() == 1


# --- tables ---


def test_missing_table_reads_empty(spark):
    assert read_or_empty(spark, shared_folder(spark) + "/none", ORDER_DETAIL).collect() == []


def test_batches_repeat_safely_and_the_last_write_wins(spark):
    path = shared_folder(spark)
    schema = "dt string, k int, n int, v string"
    kind = spark.createDataFrame([], schema).schema

    def write(batch, *rows):
        batches.write_batch(spark.createDataFrame(list(rows), schema), batch, path, "dt")

    write("q-0", ("d1", 1, 0, "old"), ("d2", 2, 0, "kept"))
    write("q-1", ("d1", 1, 1, "half"))
    write("q-1", ("d1", 1, 1, "new"), ("d1", 3, 1, "more"))
    write("q-2")
    got = batches.read_latest(spark, path, kind, ["dt", "k"], ["n"])
    expected = [("d1", 1, 1, "new"), ("d1", 3, 1, "more"), ("d2", 2, 0, "kept")]
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_current_rows_are_kept_by_bucket(spark, monkeypatch):
    """A batch reads and writes the buckets it touches alone; repeats change nothing."""
    path = shared_folder(spark)
    schema = "t string, id string, n int, v string"
    kind = spark.createDataFrame([], schema).schema
    listed = []
    read = current._read
    monkeypatch.setattr(current, "_read", lambda s, p, k, folders: listed.append(folders) or read(s, p, k, folders))

    def write(*rows):
        current.write_current(spark.createDataFrame(list(rows), schema), path, kind, "t", ["t", "id"], ["n"])

    def held():
        rows = current.read_current(spark, path, kind, "t", "a")
        assert rows.count() <= 3 * 102
        return {r.id: (r.n, r.v) for r in latest_per_key(rows, ["id"], ["n"]).collect()}

    write(*[("a", str(i), 0, "old") for i in range(100)], ("b", "1", 0, "other"))
    for n in (3, 1, 2, 3):
        write(("a", "7", n, f"v{n}"), ("a", "new", n, "x"))
    write()
    # another number of buckets: the last row counts, wherever it lies
    moved = spark.createDataFrame([("a", "9", 5, "moved")], schema)
    current.write_current(moved, path, kind, "t", ["t", "id"], ["n"], buckets=7)
    want = {str(i): (0, "old") for i in range(100)} | {"7": (3, "v3"), "new": (3, "x"), "9": (5, "moved")}
    assert held() == want
    touched = [f for folders in listed[1:5] for f in folders]
    assert all(f.startswith("t=a/buckets=16/bucket={") and f.count(",") <= 1 for f in touched) and len(touched) == 4
    # both slots hold the key: were the one being written lost, the other has it
    slots = spark.read.schema("t string, id string, n int, generation long, buckets int, bucket int, slot int").parquet(path)
    newest = slots.where("id = '7'").agg(F.max("generation"), F.count("*")).first()
    assert newest[0] >= 4 and newest[1] == 2
    assert latest_per_key(current.read_current(spark, path, kind, "t", "b"), ["id"], ["n"]).count() == 1


def test_keys_are_looked_up_in_their_buckets(spark):
    """The files that are read fall with the keys, under whatever number of buckets they lie."""
    path = shared_folder(spark)
    schema = "t string, id string, n int, v string"
    kind = spark.createDataFrame([], schema).schema
    rows = [("a", str(i), 0, "old") for i in range(400)]
    current.write_current(spark.createDataFrame(rows, schema), path, kind, "t", ["t", "id"], ["n"], buckets=64)
    current.write_current(spark.createDataFrame([("a", "7", 1, "new"), ("a", "x", 1, "y")], schema), path, kind, "t", ["t", "id"], ["n"], buckets=8)

    def asked(*ids):
        return current.read_current(spark, path, kind, "t", "a", spark.createDataFrame([(i,) for i in ids], "id string"))

    def buckets(df):
        return {tuple(p for p in f.split("/") if "bucket" in p) for f in df.inputFiles()}

    found = asked("7", "7", "none")
    assert {r.id: r.v for r in latest_per_key(found, ["id"], ["n"]).collect()} == {"7": "new"}
    assert len(buckets(found)) <= 4 < 32 < len(buckets(asked(*map(str, range(400)))))
    assert "bucket" in plan_of(found)
    assert latest_per_key(asked(*map(str, range(400)), "x"), ["id"], ["n"]).count() == 401
    assert asked().count() == 0
    assert current.read_current(spark, path, kind, "t", "b", spark.createDataFrame([("7",)], "id string")).count() == 0
    into = shared_folder(spark)
    current.rebucketed(spark, path, kind, "t", ["t", "id"], ["n"], into, 4)
    held = current.read_current(spark, into, kind, "t", "a")
    assert (held.count(), held.where("id = '7' AND v = 'new'").count()) == (401, 1)
    assert current.levels(spark, f"{into}/t=a") == [4]


def test_buckets_grow_with_the_table(spark, monkeypatch):
    path = shared_folder(spark)
    assert current.buckets_for(spark, path) == current.BUCKETS
    kind = spark.createDataFrame([], "t string, id string, n int").schema
    current.write_current(spark.range(1000).selectExpr("'a' AS t", "cast(id AS string) AS id", "1 AS n"), path, kind, "t", ["t", "id"], ["n"], buckets=32)
    assert current.buckets_for(spark, path) == 32
    monkeypatch.setattr(current, "BUCKET_BYTES", 100)
    assert current.buckets_for(spark, path) > 100


def test_lookups_and_pairs_leave_the_plan_to_spark(spark):
    """Nothing runs while they are planned, and no rows are counted in one task."""
    h, d = spark.range(1000).select("id", F.lit("x").alias("status")), spark.range(5000).select("id", (F.col("id") % 1000).alias("order_id"))
    group = "planning"
    spark.sparkContext.setJobGroup(group, "none should run")
    plans = [plan_of(orders.pair(h, d)), plan_of(skew.lookup_join(d, h.withColumnRenamed("id", "k"), "order_id", "k"))]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    assert all("SinglePartition" not in p and "GlobalLimit" not in p for p in plans)


def test_a_key_of_half_a_percent_is_heavy_with_many_partitions(spark):
    lines = spark.range(20_000).select("id", F.when(F.col("id") < 100, 1).otherwise(F.col("id") + 10).alias("order_id"))
    heads = spark.range(1, 3).select("id", F.lit("h").alias("status"))
    with settings(spark, {"spark.sql.shuffle.partitions": "2000", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        assert skew.heavy_keys(lines, "order_id") == [1]
    with settings(spark, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        both = orders.pair(heads, lines.repartition(4), "full_outer", [1])
        tasks = both.where("header.id = 1").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in tasks) == 100 and len(tasks) > 4
        assert both.count() == 20_001


def test_heavy_keys_with_very_many_partitions(spark):
    """Frequent-item counting has a smallest share; more partitions don't go below it."""
    lines = spark.range(30_000).select(F.when(F.col("id") < 60, 1).otherwise(F.col("id") + 10).alias("order_id"))
    for partitions in ("60000", "10000000"):
        with settings(spark, {"spark.sql.shuffle.partitions": partitions}):
            share = skew.heavy_share(lines)
            with settings(spark, {"spark.sql.shuffle.partitions": "8"}):
                assert skew.heavy_keys(lines, "order_id", share) == [1]


def test_misses_are_observed(spark):
    facts = spark.createDataFrame([("1", "7"), ("2", "7"), (None, "8")], "user_id string, province_id string")
    users = spark.createDataFrame([("1", "F", "2000-01-01")], "id string, gender string, birthday string")
    provinces = spark.createDataFrame([("7", "N", "n", "n-1", "07")], "id string, name string, iso_code string, iso_3166_2 string, area_code string")
    seen = Observation("misses")
    wide = with_user_and_province(facts, users, provinces, misses=seen)
    assert wide.count() == 3
    assert seen.get == {"users_missing": 2, "provinces_missing": 1}
