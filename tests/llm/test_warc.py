from base64 import b32encode
from hashlib import sha1

import pytest

from millrace.llm import warc

ROWS = [
    (5, "http://a/", "same"), (3, "http://b/", "same"), (9, None, "same"), (3, "http://b/", "same"), (1, "http://c/", None), (2, "u\r\nWARC-Type: x", ""),
    (4, "http://d/", "é\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n\r\n"), (None, "http://e/", "nobody"), (None, None, "nobody"), (None, "http://f/", "same"),
    (6, "http://g/", "long " * 200_000), (7, "http://h/", "\r\n\r\n"), (8, "http://i/", "tail\r\n"),
]


def wanted(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        own = first.get(html or "") if len(payload) >= least else page
        digest = b32encode(sha1(payload).digest()).decode()
        kind = "response" if own == page else "revisit"
        out.append((page, len(payload), digest, kind, own if kind == "revisit" else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_written_and_read_back(llm, tmp_path, least):
    frame = llm.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS bytes", "3 AS first")
    warc.write(frame, f"{tmp_path}/a", least)
    found = warc.read(llm, f"{tmp_path}/a")
    assert sorted(map(tuple, warc.resolve(found).collect()), key=repr) == wanted(ROWS, least)
    texts = {r.page_id: bytes(r.payload).decode() for r in found.where("record_type = 'response'").collect()}
    assert texts[4] == ROWS[6][2] and texts[6] == ROWS[10][2] and texts[7] == "\r\n\r\n" and texts[8] == "tail\r\n"


def test_empty_table_and_small_archives(llm, tmp_path, monkeypatch):
    frame = llm.createDataFrame(ROWS, "page_id long, url string, html string")
    warc.write(frame.limit(0), f"{tmp_path}/none")
    assert warc.read(llm, f"{tmp_path}/none").count() == 0
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 10)
    warc.write(frame, f"{tmp_path}/many")
    assert warc.read(llm, f"{tmp_path}/many").count() == len(ROWS)


def test_record_is_well_formed(llm):
    frame = llm.createDataFrame([(1, "http://a/ b", "xé"), (2, "http://c/", "xé")], "page_id long, url string, html string")
    texts = sorted(r.value for r in warc.records(warc.resolved(frame), "2024-01-01T00:00:00Z").collect())
    for text in texts:
        head, _, block = text.encode().partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        assert f"Content-Length: {len(block)}".encode() in head
    assert "WARC-Target-URI: http://a/%20b\r\n" in texts[0]
    record_id = texts[0].split("WARC-Record-ID: ")[1].split("\r\n")[0]
    assert f"WARC-Refers-To: {record_id}\r\n" in texts[1] and texts[1].endswith("\r\n\r\n")
