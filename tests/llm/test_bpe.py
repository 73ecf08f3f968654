import hashlib

import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, queries

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "It's I'LL we'd 'S 'tis don't 12345 ²³ ½"), (5, "A<|endoftext|>b <|startoftext|><|ENDOFTEXT|>"),
    (6, "étude Å Å ﬁ ſt İstanbul ΣΑΣ ς"), (7, "漢字 かな 한국어 😀😀 ‍ x y\u0085z   w\x1cv\x00u"), (7, "repeat"), (7, "repeat"),
    (None, "null key"), (8, "word " * 100_000), (9, "!!'s ''re _a_b__ $%^ ---'tis"), (10, "soft­hyphen naïve Œuvre ŉ ĳ Ǆ"), (11, "<|endoftext|>"), (12, "\0\0 \0x"),
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(queries.word_bpe())


def wanted(tokenizer, rows):
    out = []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out.append((key, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=repr)


def test_query_is_the_library_result(llm, documents, tokenizer):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [(k, len(i), digest(" ".join(map(str, i))), digest(d)) for k, i, d in wanted(tokenizer, [d[:2] for d in documents])]
    assert sorted(map(tuple, queries.op4_bpe(llm, FOLDER).collect())) == sorted(want)


@pytest.mark.parametrize("chars", [1, 50, 10**7])
def test_odd_texts_and_blocks(llm, tokenizer, monkeypatch, chars):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", chars)
    monkeypatch.setattr(bpe, "SLICE_WORDS", chars)
    frame = llm.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS block")
    got = sorted(map(tuple, bpe.encode(frame, queries.word_bpe()).collect()), key=repr)
    assert got == wanted(tokenizer, ODD)


def test_empty_and_wordless(llm):
    frame = llm.createDataFrame([("a", None), ("a", " ")], "doc_id string, text string")
    assert [tuple(r) for r in bpe.encode(frame, queries.word_bpe()).collect()] == [("a", [], "")] * 2
    assert bpe.encode(frame.limit(0), queries.word_bpe()).count() == 0


def test_decode_of_any_ids(llm, tokenizer):
    rows = [(1, [320, 4, 49407, 320]), (2, []), (3, None), (4, [999_999, 5])]
    got = {r[0]: r[1] for r in bpe.decode_ids(llm.createDataFrame(rows, "doc_id long, ids array<int>"), queries.word_bpe()).collect()}
    assert got == {1: tokenizer.decode(rows[0][1], skip_special_tokens=False), 2: "", 3: "", 4: tokenizer.decode([5])}


def test_other_tokenizer(llm):
    spec = open(__import__("public_tokenizers").path("byte_bpe_50k.json")).read()
    rows = [(1, "Hello  world, it's <|endoftext|> ok\n\n x"), (2, "naïve 漢字 123 \0\0x \0")]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1] for r in bpe.encode(frame, spec, decode=False).collect()}
    assert got == {k: Tokenizer.from_str(spec).encode(t, add_special_tokens=False).ids for k, t in rows}
