import pytest
from compare import assert_same, connect

import __spark_entry__ as driver
from millrace.plans.oracle import ORACLE
from millrace.plans.queries import QUERIES
from millrace.plans.stream_queries import STREAM_QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(autouse=True)
def compiled(spark):
    """These run as they do outside of tests, with compiled plans."""
    before = spark.conf.get("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", before)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert_same(driver.queries()[name](spark, FOLDER), con, driver.oracle_sql()[name])


def test_every_query_has_sql():
    assert {*QUERIES, *STREAM_QUERIES} == set(ORACLE)
    assert {*QUERIES, *STREAM_QUERIES} <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
