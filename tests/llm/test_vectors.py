from fractions import Fraction
from math import floor

import numpy as np
import pytest

from millrace.llm import hnsw, queries, topk

FOLDER = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")
INVALID = [(901, None), (902, []), (903, [1.0, None, 0.0]), (904, [NAN, 1.0, 0.0]), (905, [INF, 0.0, 1.0])]


def brute(rows, asks, score, k=5):
    out = []
    for q, v in {(q, tuple(v)) for q, v in asks}:
        found = [(-score(v, x), i is None, i or 0, i) for i, x in rows if len(x) == len(v) and (i is None or i != q)]
        out += [(q, n + 1, e[3], -e[0]) for n, e in enumerate(sorted(found, key=lambda e: e[:3])[:k])]
    return sorted(out, key=repr)


def cosine(a, b):
    return float(hnsw.cosines(np.array(a, float), np.array([b], float))[0])


def dot(a, b):
    return sum(int(x) * int(y) for x, y in zip(a, b, strict=True))


def embeddings(llm):
    return [(r[0], r[1]) for r in llm.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]


def recall(got, want):
    best = {}
    for q, _, i, _ in want:
        best.setdefault(q, set()).add(i)
    return sum(i in best[q] for q, _, i, _ in got) / sum(map(len, best.values()))


def test_recall_of_the_query(llm, monkeypatch):
    monkeypatch.setattr(hnsw, "BEAM", 40)
    rows = embeddings(llm)
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], cosine)
    got = [tuple(r) for r in queries.op9_neighbours(llm, FOLDER).collect()]
    assert len(got) == len(want) and recall(got, want) >= 0.95
    of = dict(rows)
    for q, _, i, s in got:
        assert s == pytest.approx(cosine(of[q], of[i]), abs=1e-12)
    for q in {g[0] for g in got}:
        own = sorted((g for g in got if g[0] == q), key=lambda g: g[1])
        assert [g[1] for g in own] == [1, 2, 3, 4, 5]
        assert own == sorted(own, key=lambda g: (-g[3], g[2]))


def test_shards_are_merged(llm, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 100)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 3)
    rows = embeddings(llm)
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS shard")
    got = [tuple(r) for r in hnsw.search(frame, frame.where("vec_id % 50 = 0")).collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], cosine)
    assert [(q, n, i) for q, n, i, _ in sorted(got, key=repr)] == [(q, n, i) for q, n, i, _ in want]


def test_graph_of_near_copies_is_whole():
    """Islands of near copies are reached, and a beam as large as the shard finds all."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 16))
    rows = np.concatenate([c + 1e-4 * rng.normal(size=(300, 16)) for c in centres] + [rng.normal(size=(50, 16))])
    rows = rows[rng.permutation(len(rows))]
    v = hnsw.units(rows)
    layers = [hnsw.layer(v, of, hnsw.LINKS * 2 if i == 0 else hnsw.LINKS) for i, of in enumerate(hnsw.levels(len(rows)))]
    graph = hnsw.Graph(rows, layers)
    assert len(graph.search(rows[0], len(rows) - 1)) == len(rows) - 1
    hits = 0
    for i in range(0, len(rows), 13):
        found = graph.search(rows[i], 60)
        exact = np.argsort(-hnsw.cosines(rows[i], rows), kind="stable")[:5]
        hits += len(set(exact.tolist()) & set(found.tolist()))
    assert hits >= 0.9 * 5 * len(range(0, len(rows), 13))


ODD = [
    (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 1.0, 0.0]), (50, [1.0, 1.0, 0.0]), (50, [1.0, 1.0, 0.0]),
    (50, [0.0, 0.0, 3.0]), (4, [1.0, 2.0]), (100, [1.0, 2.0]), (None, [1.0, 0.0, 0.0]), (150, [1.0, 2.0, 3.0, 4.0]), *INVALID,
]
ODD += [(i, [1.0, 0.0, 0.0]) for i in range(20, 40)]


def test_odd_vectors_by_cosine(llm):
    rows = [*ODD, (906, [0.0, 0.0, 0.0]), (200, [0.0, 0.0, 0.0]), (7, [1e-200, 1e200, 0.0])]
    good = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in hnsw.search(frame, frame.where("vec_id % 50 = 0")).collect()), key=repr)
    once = list({(i, tuple(v)) for i, v in good})  # repeated rows have one id
    assert got == brute(once, [r for r in good if r[0] is not None and r[0] % 50 == 0], cosine)
    assert hnsw.search(frame.limit(0), frame.limit(0)).count() == 0
    assert hnsw.search(frame, frame.limit(0)).count() == 0


@pytest.mark.parametrize("rows_of_shard", [3, 4096])
def test_odd_vectors_by_inner_product(llm, monkeypatch, rows_of_shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", rows_of_shard)
    good = [r for r in ODD if r[1] and all(x is not None and np.isfinite(x) for x in r[1])] + [(8, [0.0, 0.0, 0.0])] * 7
    frame = llm.createDataFrame([*ODD, *[(8, [0.0, 0.0, 0.0])] * 7], "vec_id long, embedding array<double>")
    whole = frame.select("vec_id", topk.quantised(frame.embedding, 256).alias("vector"), frame.vec_id.alias("n"))
    got = sorted((tuple(r) for r in topk.search(whole, whole.where("vec_id % 50 = 0")).collect()), key=repr)
    scaled = [(i, [int(256 * x) for x in v]) for i, v in good]
    assert got == brute(scaled, [r for r in scaled if r[0] is not None and r[0] % 50 == 0], dot)
    assert topk.search(whole.limit(0), whole.limit(0)).count() == 0


def test_bounds_keep_the_best(monkeypatch):
    rng = np.random.default_rng(5)
    for x in (rng.integers(-99, 99, (500, 8)), rng.integers(0, 3, (500, 4)), np.ones((40, 3), int), rng.integers(-9, 9, (3, 2))):
        asks = rng.integers(-9, 9, (70, x.shape[1]))
        own = np.arange(70)
        chosen = topk.Lists(np.arange(len(x)), x.astype(float)).candidates(asks.astype(float), own, 5)
        for j, ask in enumerate(asks):
            scores = x @ ask
            want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != j)[:5]
            assert {i for _, i in want} <= set(chosen[j].tolist())
            assert j not in chosen[j]


def test_outliers_are_scored_exactly(llm, monkeypatch):
    """Components beyond what sums in a double hold, among rows and queries; scores beyond a long."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    rng = np.random.default_rng(11)
    rows = [(i, rng.uniform(-1, 1, 4).tolist()) for i in range(150)]
    rows += [(200 + i, (rng.choice([-1, 1], 4) * 10.0 ** rng.integers(0, 11, 4)).tolist()) for i in range(60)]
    rows += [(300, [3e38, 0.0, 0.0, 1.5]), (301, [-3e38, 3e38, 0.0, 0.0]), (302, [0.0, 2.0**60 + 512, -(2.0**60), 0.001]), (350, [2.0**-8, 0.0, 0.0, 0.0])]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = frame.select("vec_id", topk.quantised(frame.embedding, 256).alias("vector"))
    got = sorted((tuple(r) for r in topk.search(whole, whole.where("vec_id % 10 = 0")).collect()), key=repr)
    scaled = [(i, [floor(256 * Fraction(x)) for x in v]) for i, v in rows]

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a, b, strict=True)), topk.LEAST), topk.MOST)

    assert got == brute(scaled, [r for r in scaled if r[0] % 10 == 0], score)
    assert {abs(g[3]) for g in got} >= {topk.MOST}


def test_repeats_of_the_query_row_leave_its_copies(llm):
    rows = [(50, [1.0, 2.0])] * 6 + [(i, [1.0, 2.0]) for i in range(51, 60)] + [(7, [1.0, 2.1]), (None, [3.0, -1.0]), (None, [3.0, -1.0]), (100, [3.0, -1.0])]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r)[:3] for r in hnsw.search(frame, frame.where("vec_id IN (50, 100)")).collect()), key=repr)
    assert [g[2] for g in got if g[0] == 50] == [51, 52, 53, 54, 55]
    assert [g[2] for g in got if g[0] == 100] == [None, None, 50, 50, 50]
