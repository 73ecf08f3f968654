"""Large sinks: nothing is sorted to be written, and nothing stays that is not needed."""

import time

from pyspark.sql import functions as F

from millrace.sinks import batches


def last_plan(spark):
    seen = spark._jsparkSession.sharedState().statusStore().executionsList()
    return seen.apply(seen.size() - 1).physicalPlanDescription()


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_rows_are_stored_unsorted_and_their_shuffle_goes(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).alias("dt"), "id")
    before, kept = {name: spark.conf.get(name) for name in batches.UNSORTED}, shuffles(spark)
    for _ in range(2):
        batches.write_batch(rows.repartition(4, "id"), "b", f"{tmp_path}/t", "dt", shuffled=False)
    assert " Sort " not in last_plan(spark) and "WriteFiles" in last_plan(spark)
    assert {name: spark.conf.get(name) for name in batches.UNSORTED} == before
    until = time.time() + 20
    while shuffles(spark) > kept and time.time() < until:
        time.sleep(0.1)
    assert shuffles(spark) <= kept
    stored = spark.read.schema("id long, dt string, batch string").parquet(f"{tmp_path}/t")
    assert sorted(map(tuple, stored.select("dt", "id").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
