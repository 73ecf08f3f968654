from zlib import crc32

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEACHES = [i for i in range(200) if crc32(str(i).encode()) % 3 != 1]
HELD_OUT = [i for i in range(200) if crc32(str(i).encode()) % 3 == 1]


def stage(llm, rows):
    docs = llm.createDataFrame([(i, t, lang, "a", 1) for i, t, lang in rows], SCHEMA)
    out = corpus_pipeline.language_id(llm, docs, "")
    assert out.columns == docs.columns
    return sorted((r.doc_id, r.lang) for r in out.collect())


@pytest.mark.parametrize("lang", [None, "en"])
def test_where_nothing_was_learned_texts_stay(llm, lang):
    """Without a label, or with labels on held-out documents alone."""
    a, b, c, d = HELD_OUT[:4]
    got = stage(llm, [(a, "clean text of a document", lang), (b, "Ωμέγα 漢字", lang), (c, None, lang), (d, "12 34 ...", lang)])
    assert got == [(a, lang), (b, lang)]


def test_texts_in_no_learned_language_go(llm):
    a, b, *more = TEACHES
    rows = [(i, f"the words of this text are english and the rest too {i}", "en") for i in more[:20]]
    odd = [(a, "漢字仮名交じり文", None), (HELD_OUT[0], "漢字仮名交じり文", "en"), (HELD_OUT[1], "漢字仮名交じり文", "ja"), (b, "the text of this", None)]
    assert stage(llm, rows + odd) == sorted([(r[0], "en") for r in rows] + [(HELD_OUT[1], "ja"), (b, "en")])
