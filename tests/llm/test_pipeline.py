"""The pipeline against plain Python, stage by stage."""

import re
from hashlib import md5

import corpus_pipeline
from test_plain_operators import brute_targets
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from millrace.llm import queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def deduplicated(rows):
    prints = [(r[0], brute_fingerprint(r[1], 3)) for r in rows]
    return [r for r, c in zip(rows, brute_components(prints), strict=True) if r[0] == c]


def copies(rows):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    rate = {s: t / sizes[s] if sizes[s] else 0 for s, t in brute_targets(sizes).items()}
    for r in rows:
        draw = int(md5(f"42:{r[0]}".encode()).hexdigest()[:12], 16) / 2**48
        yield r, int(rate[r[3]]) + (draw < rate[r[3]] % 1)


def test_run_is_the_brute_force_result(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    tokenizer = Tokenizer.from_str(queries.word_bpe())
    want = []
    for r, n in copies(deduplicated(lettered)):
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids
        want += [(r[0], len(ids), ids, tokenizer.decode(ids, skip_special_tokens=False))] * n
    got = [tuple(r) for r in corpus_pipeline.run(llm, FOLDER).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns_and_odd_rows(llm):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "12 34", "en", "a", 5), (None, "the and of that", None, None, 1)]
    rows += [(4, "the words of this text stay", "en", "b", 1)] * 3 + [(i, f"all different words {i * 7919} in {i} here", "en", "b", 2) for i in range(10, 30)]
    docs = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS fp", "3 AS size", "4 AS block", "5 AS _key", "6 AS _mark", "7 AS `row`", "8 AS key", "9 AS mark", "10 AS _of", "11 AS _copy", "12 AS root", "13 AS id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, docs, FOLDER)
        assert out.columns == docs.columns
        docs = llm.createDataFrame(out.collect(), docs.schema)
    assert docs.where("text IS NULL OR text = '' OR doc_id = 3").count() == 0
    for frame in (docs, docs.limit(0)):
        assert corpus_pipeline.tokens(llm, frame, FOLDER).count() == frame.count()


def test_empty_documents(llm):
    docs = llm.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, docs, FOLDER).count() == 0
