import pytest
from compare import assert_same, connect
TABLES = "documents embeddings pages benchmark labels conversations".split()
FOLDER = "/root/testdata/sf0.001"

from millrace.llm.oracle import LLM_ORACLE
from millrace.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def con():
    con = connect(FOLDER)
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(llm, con, name):
    assert_same(LLM_QUERIES[name](llm, FOLDER), con, LLM_ORACLE[name])
