"""Approximate nearest neighbours: a navigable small-world graph for each shard.

Vectors are dealt to shards of bounded size by hash. A shard's graph has layers: each
node is in layer 0, one in LINKS of them in layer 1, and so on. A search walks
greedily down the upper layers and keeps a beam in layer 0. Graphs are stored as flat
arrays of neighbours, a row for each shard; every shard is searched, and the shards'
results are merged.

A shard is small enough to find a node's candidates in it exactly, block by block.
Which of them become links is decided as usual: a candidate is taken if it is nearer
to the node than to any link taken before. Each node is also linked, both ways, with
the nearest of the nodes before it, so that a layer is connected and all is reachable.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.vectors import asked, best, matrix, pieces, points, spread

# Different vectors of a shard, links of a node above layer 0, candidates of a link.
SHARD_ROWS = 8_192
LINKS = 16
CANDIDATES = 64
# Nodes that a search keeps in layer 0. A shard of no more is searched whole.
BEAM = 160
QUERY_BLOCK = 8_192
BLOCK = 256


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def units(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """In double precision, row by row: equal rows have equal cosines."""
    q, x = scaled(query[None]), scaled(rows)
    return (x * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(axis=1)))


def diverse(v: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> list[np.ndarray]:
    """Of each node's candidates (nearest first, -1 for none) those that become links."""
    out = []
    for i in range(0, len(nodes), BLOCK):
        of, to = nodes[i : i + BLOCK], near[i : i + BLOCK]
        x = v[np.maximum(to, 0)]
        own = np.where(to >= 0, np.einsum("ncd,nd->nc", x, v[of]), -np.inf)
        among = np.matmul(x, x.transpose(0, 2, 1))
        taken = np.zeros(to.shape, bool)
        closest = np.full(to.shape, -np.inf)  # to a link taken before
        for c in range(to.shape[1]):
            fits = (to[:, c] >= 0) & (own[:, c] > closest[:, c]) & (taken.sum(axis=1) < most)
            taken[:, c] = fits
            closest = np.where(fits[:, None], np.maximum(closest, among[:, c]), closest)
        out += [t[k] for t, k in zip(to, taken, strict=True)]
    return out


def layer(v: np.ndarray, nodes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``nodes``: (bounds, neighbours), a node's from bounds[i] to bounds[i + 1]."""
    n, x = len(nodes), v[nodes]
    width = min(CANDIDATES, n - 1)
    near = np.full((n, width), -1)
    parent = np.zeros(n, np.int64)
    for i in range(0, n, BLOCK):
        sims = x[i : i + BLOCK] @ x.T
        at = np.arange(len(sims))
        sims[at, at + i] = -np.inf
        if width:
            part = np.argpartition(-sims, width - 1, axis=1)[:, :width]
            near[i : i + BLOCK] = np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, 1), axis=1), 1)
        earlier = np.where(np.arange(n)[None, :] < (at + i)[:, None], sims, -np.inf)
        parent[i : i + BLOCK] = earlier.argmax(axis=1)
    links: list[set[int]] = [set() for _ in range(n)]
    if width:
        chosen = diverse(x, np.arange(n), near, most)
        back: list[list[int]] = [[] for _ in range(n)]
        for i, own in enumerate(chosen):
            links[i].update(own.tolist())
            for j in own.tolist():
                back[j].append(i)
        full = [i for i in range(n) if len(links[i].union(back[i])) > most]
        for i in range(n):
            links[i].update(back[i])
        again = np.full((len(full), CANDIDATES), -1)
        for row, i in enumerate(full):
            to = np.array(sorted(links[i]))
            to = to[np.argsort(-(x[to] @ x[i]), kind="stable")][:CANDIDATES]
            again[row, : len(to)] = to
        for i, kept in zip(full, diverse(x, np.array(full, np.int64), again, most), strict=True):
            links[i] = set(kept.tolist())
        for i in range(1, n):
            links[i].add(int(parent[i]))
            links[int(parent[i])].add(i)
    bounds = np.cumsum([0, *map(len, links)])
    flat = np.array([nodes[j] for of in links for j in sorted(of)], np.int64)
    return bounds, flat


def levels(n: int) -> list[np.ndarray]:
    """The nodes of each layer: every LINKS-th of the layer below."""
    out = [np.arange(n)]
    while len(out[-1]) > LINKS:
        out.append(out[-1][::LINKS])
    return out


class Graph:
    """A shard's vectors and the flat arrays of its layers."""

    def __init__(self, rows: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.rows, self.v, self.layers, self.n = rows, units(rows), layers, len(rows)
        self.place = [{int(x): i for i, x in enumerate(of)} for of in levels(self.n)]

    def neighbours(self, level: int, node: int) -> np.ndarray:
        bounds, flat = self.layers[level]
        i = node if level == 0 else self.place[level][node]
        return flat[bounds[i] : bounds[i + 1]]

    def search(self, query: np.ndarray, beam: int) -> np.ndarray:
        """Up to ``beam`` nodes near the query, of which the nearest it met."""
        if self.n <= beam:
            return np.arange(self.n)
        q = units(query[None])[0]
        node = 0
        near = float(self.v[0] @ q)
        for level in range(len(self.layers) - 1, 0, -1):
            while len(to := self.neighbours(level, node)):
                sims = self.v[to] @ q
                i = int(sims.argmax())
                if sims[i] <= near:
                    break
                node, near = int(to[i]), float(sims[i])
        seen = np.zeros(self.n, bool)
        seen[node] = True
        ahead, kept = [(-near, node)], [(near, node)]
        bounds, flat = self.layers[0]
        while ahead:
            far, node = heapq.heappop(ahead)
            if len(kept) == beam and -far < kept[0][0]:
                break
            to = flat[bounds[node] : bounds[node + 1]]
            to = to[~seen[to]]
            seen[to] = True
            sims = self.v[to] @ q
            if len(kept) == beam:
                good = sims > kept[0][0]
                to, sims = to[good], sims[good]
            for s, i in zip(sims.tolist(), to.tolist(), strict=True):
                heapq.heappush(ahead, (-s, i))
                if len(kept) < beam:
                    heapq.heappush(kept, (s, i))
                elif s > kept[0][0]:
                    heapq.heapreplace(kept, (s, i))
        return np.array([i for _, i in kept])


SHARD = "dim int, shard int, members array<array<long>>, vectors array<double>, sizes array<int>, bounds array<int>, flat array<int>"


def index(rows: DataFrame, key: str, vector: str, k: int) -> tuple[DataFrame, int]:
    """The graphs, a row for each shard, and the number of shards.

    Every row is indexed whose vector is valid and not zero. Equal vectors are one node
    that lists the k + 1 smallest of their different ids: a query's k nearest, its own
    id apart, can be among no others. A repeated row (id and vector) counts up to k
    times. Vectors of another dimension are other shards.
    """
    nonzero = points(rows, key, vector).where(F.exists("v", lambda x: x != 0))
    given = nonzero.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    order = Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last())
    first = given.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    nodes = staged(first.groupBy("v").agg(F.flatten(F.collect_list(F.array_repeat("id", F.col("n")))).alias("ids")), "nodes")
    shards = pieces(nodes.count(), SHARD_ROWS)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        x = matrix(table["v"])
        v = units(x)
        layers = [layer(v, of, LINKS * 2 if i == 0 else LINKS) for i, of in enumerate(levels(len(x)))]
        return pa.table(
            {
                "dim": pa.array([x.shape[1]], pa.int32()),
                "shard": table["shard"][:1],
                "members": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "vectors": pa.array([x.ravel()], pa.list_(pa.float64())),
                "sizes": pa.array([[len(b) for b, _ in layers]], pa.list_(pa.int32())),
                "bounds": pa.array([np.concatenate([b for b, _ in layers])], pa.list_(pa.int32())),
                "flat": pa.array([np.concatenate([f for _, f in layers])], pa.list_(pa.int32())),
            }
        )

    dealt = nodes.select(
        "v", "ids", F.size("v").alias("dim"), F.xxhash64("v").alias("order"),
        F.pmod(F.xxhash64(F.lit("shard"), "v"), F.lit(shards)).cast("int").alias("shard"),
    )
    return dealt.groupBy("dim", "shard").applyInArrow(build, SHARD), shards


def unpack(row: pa.Table) -> tuple[Graph, list[list[int | None]]]:
    dim = row["dim"][0].as_py()
    x = np.array(row["vectors"][0].values).reshape(-1, dim)
    bounds, flat = np.array(row["bounds"][0].values), np.array(row["flat"][0].values)
    layers, at, start = [], 0, 0
    for size in row["sizes"][0].as_py():
        b = bounds[at : at + size]
        layers.append((b, flat[start : start + b[-1]]))
        at, start = at + size, start + int(b[-1])
    return Graph(x, layers), row["members"][0].as_py()


def nearest(graph: Graph, members: list, query: np.ndarray, own: int | None, k: int, beam: int) -> Iterator[tuple]:
    """(vec_id, cosine) of the shard's k nearest found, the query's own rows apart."""
    found = graph.search(query, beam)
    scores = cosines(query, graph.rows[found])
    each = [
        (-s, i is None, i or 0, i)
        for s, node in zip(scores.tolist(), found.tolist(), strict=True)
        for i in members[node]
        if i is None or i != own
    ]
    for s, _, _, i in heapq.nsmallest(k, each, key=lambda e: e[:3]):
        yield i, -s


def search(
    rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, beam: int = BEAM
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows found, by cosine.

    ``queries`` has the columns of ``rows``. Null, empty and zero vectors and those with
    null or non-finite components take no part; rows of a query's id are no candidates
    of it, and vectors of another dimension neither. A null id is a candidate like
    others, the last among ties. Repeated queries count once, repeated rows each. With
    fewer candidates than k all are given; without any, nothing.
    """
    graphs, shards = index(rows, key, vector, k)
    graphs = staged(graphs, "graphs")
    of = staged(asked(points(queries, key, vector).where(F.exists("v", lambda x: x != 0))), "queries")
    blocks = pieces(of.count(), QUERY_BLOCK)

    def look(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        if shard.num_rows and block.num_rows:
            graph, members = unpack(shard)
            for q, own, v in zip(block["q"].to_pylist(), block["id"].to_pylist(), matrix(block["v"]), strict=True):
                out += [(q, own, i, s) for i, s in nearest(graph, members, v, own, k, beam)]
        kinds = [("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
        return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(kinds)})

    placed = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    grid = ["dim", "shard", "block"]
    found = (
        placed.groupBy(*grid)
        .cogroup(spread(of, shards, blocks).groupBy(*grid))
        .applyInArrow(look, "q long, query_id long, vec_id long, score double")
    )
    return best(found, k)
