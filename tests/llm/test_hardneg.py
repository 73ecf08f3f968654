"""Hard negatives against plain Python."""

import random
from fractions import Fraction
from math import floor, isfinite

import pytest

from millrace.llm import hardneg

SCHEMA = "vec_id long, vector array<double>, label int"
MOST = 2**63 - 1


def brute(rows, anchors, k=5):
    def usable(r):
        return r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and isfinite(x) for x in r[1])

    def whole(v):
        return [floor(256 * Fraction(x)) for x in v]

    def place(r):
        return (r[0] is None, r[0] or 0)

    given = [(r[0], whole(r[1]), r[2]) for r in rows if usable(r)]
    out = []
    for a, v, label in {(r[0], tuple(whole(r[1])), r[2], tuple(r[1])): (r[0], whole(r[1]), r[2]) for r in anchors if usable(r)}.values():
        scored = [(r, max(-MOST - 1, min(MOST, sum(x * y for x, y in zip(v, r[1], strict=True))))) for r in given if len(r[1]) == len(v) and (a is None or r[0] != a)]
        scored.sort(key=lambda s: (-s[1], place(s[0])))
        for p, top in [s for s in scored if s[0][2] == label][:k]:
            window = [s for s in scored if s[0][2] != label and 80 * top <= 100 * s[1] <= 100 * top]
            out += [(a, p[0], i, n[0], top, s) for i, (n, s) in enumerate(window[:k], 1)]
    return sorted(out, key=repr)


def mined(llm, rows, anchors, **how):
    frame = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS q", "2 AS id", "3 AS n", "4 AS dim", "5 AS shard", "6 AS score")
    asked = llm.createDataFrame(anchors, SCHEMA).selectExpr("*", "1 AS q", "2 AS id", "3 AS n", "4 AS dim", "5 AS shard", "6 AS score")
    return sorted(map(tuple, hardneg.mine(frame, asked, **how).collect()), key=repr)


def vectors(rng, n, dim, labels=4, scale=1.0):
    return [(i, [rng.uniform(-scale, scale) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("shard", [16, 8192])
def test_as_in_plain_python(llm, monkeypatch, shard):
    monkeypatch.setattr(hardneg, "SHARD_ROWS", shard)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 7)
    rng = random.Random(shard)
    rows = vectors(rng, 300, 12) + [(r[0], [rng.uniform(-1, 1) for _ in range(5)], r[2]) for r in vectors(rng, 40, 5)]
    base = rows[3][1]
    # one vector that many have, repeated rows, ties, nulls
    rows += [(1000 + i, base, i % 4) for i in range(80)] + [(2000, base, 1)] * 9 + [(None, base, 1), (None, base, 2)] * 2
    rows += [(i, [float(rng.randrange(-1, 2)) for _ in range(12)], i % 2) for i in range(3000, 3060)]
    rows += [(5000, None, 1), (5001, [], 1), (5002, [None] * 12, 1), (5003, [float("nan")] * 12, 1), (5004, [float("inf")] * 12, 1), (5005, base, None), (5006, [0.0] * 12, 2)]
    anchors = [r for r in rows if r[0] is None or r[0] % 5 == 0]
    want = brute(rows, anchors)
    assert len(want) > 500
    assert mined(llm, rows, anchors) == want


def test_numbers_of_any_size(llm):
    """Components beyond what a double's sums hold exactly, and beyond a long."""
    rng = random.Random(5)
    rows = vectors(rng, 60, 4, labels=2)
    rows += [(100 + i, [rng.choice([-1, 1]) * 10.0 ** rng.randrange(0, 12) for _ in range(4)], i % 2) for i in range(60)]
    rows += [(300 + i, [1e300, 0.0, 0.0, rng.uniform(-1, 1)], i % 2) for i in range(4)] + [(400, [1.7e308, 1.7e308, 0.0, 0.0], 1)]
    want = brute(rows, rows)
    assert {r[4] for r in want} >= {MOST}
    assert mined(llm, rows, rows) == want


def test_bounds_leave_rows_early():
    """The first dimensions an anchor reads decide, where they are large."""
    rng = hardneg.np.random.default_rng(1)
    x = rng.normal(size=(1000, 64))
    query = hardneg.np.zeros(64)
    query[40], query[3] = 8.0, 0.01
    columns, seen = hardneg.Columns(x, 256), []
    keep = hardneg.among_best(5)

    def watched(lower, upper):
        seen.append(len(lower))
        return keep(lower, upper)

    found = columns.scores(query, hardneg.np.ones(1000, bool), watched)
    assert seen[0] == 1000 and seen[1] < 20
    exact = columns.exact(query, hardneg.np.arange(1000))
    assert sorted((s for _, s in found), reverse=True)[:5] == sorted(exact, reverse=True)[:5]


def test_few_or_no_rows(llm):
    rows = [(1, [1.0], 0), (2, [1.0], 0), (3, [0.9], 1), (4, [0.7], 1), (5, [-1.0], 0)]
    assert mined(llm, rows, rows[:1]) == [(1, 2, 1, 3, 65536, 58880)]
    assert mined(llm, rows, []) == mined(llm, [], rows) == []
    assert mined(llm, rows[:2], rows) == []
