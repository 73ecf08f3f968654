"""Sinks on large tables: what isn't asked for is not read back."""

from pyspark.sql.types import LongType, StringType, StructType

from millrace.sinks import batches


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_unasked_columns_are_not_read(spark, tmp_path):
    schema = StructType().add("dt", StringType()).add("k", LongType()).add("n", LongType()).add("unasked", StringType())
    table = spark.createDataFrame([("d", 1, 1, "x"), ("d", 1, 2, "y"), ("d", 2, 1, "z"), (None, 2, 1, "z")], schema)
    batches.write_batch(table.coalesce(1), "b", f"{tmp_path}/t", "dt", shuffled=False)
    got = batches.read_latest(spark, f"{tmp_path}/t", schema, ["dt", "k"], ["n"], ["dt", "k", "n"])
    assert rows(got) == rows(spark.createDataFrame([("d", 1, 2), ("d", 2, 1), (None, 2, 1)], "dt string, k long, n long"))
    assert "unasked:string" not in got._jdf.queryExecution().sparkPlan().toString()
    whole = batches.read_latest(spark, f"{tmp_path}/t", schema, ["dt", "k"], ["n"])
    assert ("d", 1, 2, "y") in rows(whole)
    assert sum(1 for _ in tmp_path.glob("t/**/*.parquet")) == 2
