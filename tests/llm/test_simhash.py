import random
import re

import numpy as np
import pytest
import xxhash

from millrace.llm import queries, simhash
from millrace.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def brute_fingerprint(text, words):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(parts[i : i + words]).encode(), seed=42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(rows, radius=2):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(rows))]


def expected(rows, words):
    prints = [(k, brute_fingerprint(t, words)) for k, t in rows]
    return sorted(((k, f"{f:016x}", c) for (k, f), c in zip(prints, brute_components(prints), strict=True)), key=repr)


def test_query_is_the_brute_force_result(llm, documents):
    got = sorted(map(tuple, queries.op3_simhash(llm, FOLDER).collect()), key=repr)
    assert got == expected([(d[0], d[1]) for d in documents], 3)


def test_edge_cases(llm):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É é nbsp word x"),
        (7, "É é nbsp word x"), (None, "one two"), (None, "alone here"), (8, "a " * 300_000), (9, "a a a a"),
    ]
    frame = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS root")
    got = sorted(map(tuple, simhash.near_duplicates(frame, words=3).collect()), key=repr)
    assert got == expected(rows, 3)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 700])
def test_bit_sliced_distances(n):
    rng = np.random.default_rng(n)
    fps = rng.integers(0, 2**63, n).astype(np.uint64)
    for i in range(1, n, 2):  # half of them near another
        fps[i] = fps[i - 1] ^ np.uint64(1 << int(rng.integers(64))) ^ np.uint64(1 << int(rng.integers(64)))
    q, lane = simhash.near(fps, simhash.planes(fps), n)
    want = {(i, j) for i in range(n) for j in range(n) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2}
    assert set(zip(q.tolist(), lane.tolist(), strict=True)) == want


def test_links_of_large_keys(llm, monkeypatch):
    """All share one key; tiles smaller than the key don't lose a link."""
    monkeypatch.setattr(simhash, "TILE", 50)
    rng = random.Random(1)
    fps = [rng.getrandbits(32) << 32 | 7 for _ in range(300)]
    fps += [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in fps[:200]]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = llm.createDataFrame([(f,) for f in set(signed)], "fp long")
    got = {r[0]: r[1] for r in components(simhash.links(frame)).collect()}
    groups = {}
    for fp, root in got.items():
        groups.setdefault(root, set()).add(fp)
    rows = [(i, f & (1 << 64) - 1) for i, f in enumerate(sorted(set(signed)))]
    want = {}
    for (_, f), c in zip(rows, brute_components(rows), strict=True):
        want.setdefault(c, set()).add(f - (1 << 64) if f >> 63 else f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_components_of_a_long_chain(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (99, 100), (7, 7)], "a long, b long")
    got = {r[0]: r[1] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 100: 99}


def test_one_row_of_each_component_stays(llm):
    rows = [(3, "a b c d"), (2, "A b c d"), (2, "a B c d"), (2, "A b c d"), (9, "other words here"), (None, "nobody else"), (None, "nobody else"), (9, "quite different"), (5, None), (4, "")]
    frame = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS mark", "2 AS root", "3 AS fp", "4 AS key", "5 AS _key", "6 AS _mark", "7 AS `row`", "8 AS first")
    got = simhash.one_of_each(frame, words=3)
    assert got.columns == frame.columns
    kept = sorted(((r.doc_id, (r.text or "").lower()) for r in got.collect()), key=repr)
    assert kept == sorted([(2, "a b c d"), (9, "other words here"), (9, "quite different"), (None, "nobody else"), (4, "")], key=repr)
