from collections import Counter
from zlib import crc32

import numpy as np

from millrace.llm import langid, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(llm):
    lang = {r[0]: r[1] for r in llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op6_language(llm, FOLDER).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_edge_cases(llm, documents):
    frame = llm.createDataFrame([d[:3] for d in documents], "doc_id long, text string, lang string")
    filters = langid.train(frame)
    assert filters.langs == ["de", "en", "es", "fr"]
    rows = [(1, None), (2, ""), (3, "123 ... \n|"), (4, "漢字"), (None, "of the and that is"), (6, "and the " * 200_000)]
    odd = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS lang_pred")
    assert langid.identify(odd, filters).columns == ["doc_id", "text", "lang_pred", "score"]
    got = {r[0]: (r[1], r[2]) for r in langid.identify(odd, filters, keep=["doc_id"]).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4] == ("en", 0.0)
    assert got[None][0] == got[6][0] == "en"
    assert langid.identify(odd.limit(0), filters).count() == 0


def test_nothing_to_learn_from(llm):
    frame = llm.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    for rows in (frame, frame.limit(0)):
        got = langid.identify(frame, langid.train(rows), keep=["doc_id"]).collect()
        assert [tuple(r) for r in got] == [(1, "und", 0.0), (2, "und", 0.0)]


def spelled(text):
    return " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


def plain_grams(text):
    line = spelled(text) if spelled(text).strip() else " "
    return [line[i : i + n] for n in langid.ORDERS for i in range(len(line) - n + 1)]


def plain_sets(rows):
    """The n-grams of each language, as the filters' rules choose them."""
    counts = {}
    for _, text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    best = Counter()
    for of in rates.values():
        for g, r in of.items():
            best[g] = max(best[g], r)
    return {lang: {g for g, r in of.items() if r >= langid.LEAST_RATE and r >= langid.LEAST_SHARE * best[g]} for lang, of in sorted(rates.items())}


def test_filters_agree_with_plain_sets(llm, documents):
    """Counts by the filters are those of sets, but for false positives at the measured rate."""
    rows = [d[:3] for d in documents]
    filters = langid.train(llm.createDataFrame(rows, "doc_id long, text string, lang string"))
    sets = plain_sets(rows)
    assert list(sets) == filters.langs
    agree = 0
    for _, text, _ in rows:
        grams = plain_grams(text or "")
        true = np.array([sum(g in of for g in grams) for of in sets.values()])
        hits = sum(filters.hits(h) for h in langid.grams(langid.spelled(text or "", filters.is_letter)))
        assert (hits >= true).all()
        wrong = (len(grams) - true) * filters.wrong
        assert (hits - true <= wrong + 6 * np.sqrt(wrong + 1) + 3).all()
        lang, score = filters.predict(text)
        if true.any() and any(c.isalpha() for c in text or ""):
            top = int(true.argmax())
            close = np.sort(true)[-1] - np.sort(true)[-2] <= 3 * np.sqrt(wrong.max() + 1)
            assert lang == filters.langs[top] or close
            assert abs(score - true[filters.langs.index(lang)] / true.sum()) <= 0.02 or len(grams) < 200
            agree += lang == filters.langs[top]
    assert agree >= 0.99 * len(rows)


def test_filters_contain_what_they_were_given(llm, documents):
    """A lookup may return more languages than hold an n-gram, never fewer."""
    rows = [d[:3] for d in documents]
    filters = langid.train(llm.createDataFrame(rows, "doc_id long, text string, lang string"))
    for i, of in enumerate(plain_sets(rows).values()):
        for n in langid.ORDERS:
            grams = [g for g in of if len(g) == n]
            codes = [np.array(list(map(ord, g)), np.uint32) for g in grams]
            assert all(sum(filters.hits(h)[i] for h in langid.grams(c) if len(h)) >= 1 for c in codes[:500])
