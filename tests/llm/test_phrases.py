"""Phrase collocations against plain Python."""

import random
import re
from collections import Counter

import pytest

from millrace.llm import phrases

SCHEMA = "text string, lang string"


def brute(rows, least, top=2000, longest=4):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    own = counts.setdefault(lang, Counter())
                    own[tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        often = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            cuts = [(2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items() if len(q) > len(p)
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def mined(llm, rows, **how):
    docs = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS phrase", "3 AS h", "4 AS words", "5 AS size")
    return sorted(map(tuple, phrases.collocations(docs, **how).collect()))


def texts(rng, n, words):
    out = []
    for _ in range(n):
        line = [rng.choice(words) for _ in range(rng.randrange(0, 60))]
        seps = [rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in line]
        out.append(("".join(w + s for w, s in zip(line, seps, strict=True)), rng.choice(["en", "de", None, "und"])))
    return out


def odd(rng):
    rows = texts(rng, 150, ["the", "The", "of", "é", "É", "new", "york", "new york city", " ", "x\x00y", "漢字", "is"])
    rows += [(None, "en"), ("", "en"), ("...", None), ("new york city hall " * 30, "fr"), ("word", ""), ("a b " * 20_000, "long")]
    return rows + [("one two three", "same")] * 9


@pytest.mark.parametrize("least", [3, 9])
def test_as_in_plain_python(llm, least):
    rows = odd(random.Random(least))
    want = brute(rows, least)
    assert mined(llm, rows, least=least) == want
    assert {r[0] for r in want} >= {"en", "de", "und", "fr", "long", "same"}


def test_bursts_spills_and_slices(llm, monkeypatch):
    """A task that holds little gives many runs, and the same counts."""
    rows = odd(random.Random(1))
    want = mined(llm, rows, least=3, top=40)
    for name, value in (("HELD", 40), ("BURST", 3), ("SLICE_WORDS", 50), ("NUMBERED", 6), ("BLOCK_CHARS", 200)):
        monkeypatch.setattr(phrases, name, value)
    assert mined(llm, rows, least=3, top=40) == want == brute(rows, 3, top=40)


def test_a_filter_that_lets_everything_through(llm, monkeypatch):
    rows = odd(random.Random(2))
    want = mined(llm, rows, least=4)
    monkeypatch.setattr(phrases.Filter, "has", lambda self, h: phrases.np.ones(len(h), bool))
    assert mined(llm, rows, least=4) == want


def test_a_filter_has_what_it_was_made_of(llm):
    hashes = [random.Random(i).getrandbits(64) - 2**63 for i in range(3000)]
    made = phrases.filter_of(llm.createDataFrame([(h,) for h in hashes], "h long"))
    unsigned = phrases.np.array([h & phrases.ALL for h in hashes], phrases.np.uint64)
    assert made.has(unsigned).all()
    assert made.has(unsigned ^ phrases.np.uint64(0x5555)).sum() < 60


def test_large_counts_are_exact(llm):
    """Scores of counts whose products pass 64 bits."""
    big = 4 * 10**18
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big), ("en", "a b", 2, big - 1)]
    counts = llm.createDataFrame(rows, "lang string, phrase string, size int, n long")
    assert [r.score for r in phrases.scored(counts).collect()] == [2_000_000 * (big - 1) // (2 * big + 1)]


def test_nothing_to_count(llm):
    assert mined(llm, []) == mined(llm, [(None, None)] * 50) == mined(llm, [("once only", "en")]) == []
