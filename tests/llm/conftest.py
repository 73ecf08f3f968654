import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from millrace.llm.common import prepare  # noqa: E402



@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return [tuple(r) for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
