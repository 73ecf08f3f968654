"""A sink that is written twice is the only copy of its rows."""

from millrace.plans import queries
from millrace.session import shared_folder


def day_of(sku):
    return f"2024-01-0{1 + sku * 104729 % 259200 // 86400}"


def test_wide_rows_have_no_copy_beside_the_sink(spark, tmp_path, monkeypatch):
    root, at = shared_folder(spark), f"{tmp_path}/in"
    monkeypatch.setattr(queries, "shared_folder", lambda _: root)
    rows = {
        "customer": "id AS c_custkey, 'BUILDING' AS c_mktsegment, 0D AS c_acctbal",
        "nation": "id AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey",
        "orders": "id AS o_orderkey, id % 5 AS o_custkey, 'F' AS o_orderstatus, 1.5D AS o_totalprice, TIMESTAMP'2024-01-01' AS o_orderdate, '2-HIGH' AS o_orderpriority",
        "lineitem": "id DIV 2 AS l_orderkey, id AS l_partkey, 1 AS l_linenumber, 2D AS l_quantity, 3D + id AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax, TIMESTAMP'2024-01-02' AS l_shipdate",
    }
    for name, columns in rows.items():
        spark.range(20).selectExpr(*columns.split(", ")).write.parquet(f"{at}/{name}.parquet")
    got = queries.sink_by_day(spark, at).select("dt", "detail_id", "sku_id").collect()
    # of two lines with one id and day, that with the greater sku
    days = {(day_of(k), k // 2 * 10 + 1): k for k in range(20)}
    assert sorted(map(tuple, got)) == sorted((*key, sku) for key, sku in days.items())
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    assert [f.getPath().getName() for f in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(root))] == ["order_wide"]
