from base64 import b32encode
from hashlib import sha1

from pyspark.sql import functions as F

from millrace.llm import warc


def test_base32_of_leading_zeros_and_all_signs(llm):
    hexed = ["0" * 40, "f" * 40, "00000000ff" * 4, *(sha1(str(i).encode()).hexdigest() for i in range(200))]
    got = llm.createDataFrame([(h,) for h in hexed], "h string").select("h", warc.base32(F.col("h"))).collect()
    assert all(b == b32encode(bytes.fromhex(h)).decode() for h, b in got)


def test_rows_meet_by_the_plain_digest(llm):
    """Base 32 is made for what is written, not for each row on both sides of the join."""
    pages = llm.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string")
    plan = warc.resolved(pages)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "sha1" in join and plan.count("translate(") == 1
