"""Exact top-k search by inner product, without random access.

A shard keeps a list for each dimension, sorted by that component. The score of a
query is the sum of one entry of each list, times the query's component. Lists are
read from their better end, all to the same depth. What a candidate has not shown yet
lies between the list's worst entry and the last one read, which bounds its score from
below and above. Reading stops when nobody but a few candidates can still reach the
k-th best lower bound; only their scores are then worked out.
"""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.vectors import asked, best, matrix, pieces, points, spread, valid

# Candidates of a shard; queries that go to a shard together, and that it handles at once.
SHARD_ROWS = 4_096
QUERY_BLOCK = 8_192
AT_ONCE = 256
# Parts of the lists after which bounds are compared.
DEPTHS = (0.5, 0.75, 0.85, 0.92, 0.96, 1.0)
# Whole numbers up to here, and their sums, are exact in a double.
EXACT = 2**53
LEAST, MOST = -(2**63), 2**63 - 1


class Lists:
    """A shard's sorted lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.n = ids, x, len(x)
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, order, axis=0)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(self.n)[:, None].repeat(x.shape[1], 1), axis=0)

    def candidates(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the rows that may be among its k best: all others can't."""
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        live, alive = np.arange(self.n), np.ones((self.n, len(queries)), bool)
        alive[self.ids[:, None] == own[None, :]] = False
        total = np.zeros((self.n, len(queries)))
        low, high = self.sorted[0], self.sorted[-1]
        read = 0
        for depth in DEPTHS:
            upto = int(np.ceil(depth * self.n))
            place, x = self.place[live], self.x[live]
            # from the top for positive components, from the bottom for negative ones
            top, bottom = place >= self.n - upto, place < upto
            new_top, new_bottom = top & (place < self.n - read), bottom & (place >= read)
            total += (x * new_top) @ up + (x * new_bottom) @ down
            read = upto
            if upto == self.n:
                lower = upper = total
            else:
                last_top, last_bottom = self.sorted[self.n - upto], self.sorted[upto - 1]
                lower = total + ~top @ (low[:, None] * up) + ~bottom @ (high[:, None] * down)
                upper = total + ~top @ (last_top[:, None] * up) + ~bottom @ (last_bottom[:, None] * down)
            at = max(0, len(live) - k)
            least = np.partition(np.where(alive, lower, -np.inf), at, axis=0)[at]
            alive &= upper >= least
            if (alive.sum(axis=0) <= 8 * k).all():
                break
            keep = alive.any(axis=1)
            live, alive, total = live[keep], alive[keep], total[keep]
        return [live[column] for column in alive.T]


class Shard:
    """Candidates of a shard. Vectors with components so large that a sum of products might
    not be exact in a double stand apart: their scores are worked out in Python integers."""

    def __init__(self, rows: pa.Table):
        self.x, self.names, self.times = matrix(rows["v"]), rows["id"].to_pylist(), rows["n"].to_pylist()
        # nulls equal no id, and come last among ties
        self.ids = np.array([LEAST if i is None else i for i in self.names])
        self.last = np.array([i is None for i in self.names], bool)
        self.most = isqrt(EXACT // max(1, self.x.shape[1]))
        plain = self.plain(self.x)
        self.small, self.large = plain.nonzero()[0], (~plain).nonzero()[0]
        self.lists = Lists(self.ids[self.small], self.x[self.small]) if len(self.small) else None

    def plain(self, vectors: np.ndarray) -> np.ndarray:
        return (np.abs(vectors) <= self.most).all(axis=1)

    def exact(self, query: np.ndarray, own: int, rows: np.ndarray) -> list[tuple[int, int]]:
        """(row, score) of rows with other ids; a score beyond a long is the nearest long."""
        q = list(map(int, query.tolist()))
        sums = ((r, sum(a * int(b) for a, b in zip(q, self.x[r].tolist(), strict=True))) for r in rows.tolist() if self.ids[r] != own)
        return [(r, min(max(s, LEAST), MOST)) for r, s in sums]

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """The (row, score) of each query's ``k`` first rows."""
        plain = self.plain(queries)
        found = self.lists.candidates(np.where(plain[:, None], queries, 0.0), own, k) if self.lists else [None] * len(queries)
        out = []
        for j, query in enumerate(queries):
            if not plain[j]:
                scored = self.exact(query, own[j], np.arange(len(self.x)))
            else:
                scored = self.exact(query, own[j], self.large)
                if found[j] is not None:
                    rows = self.small[found[j]]
                    scores = self.x[rows] @ query
                    first = np.lexsort((self.ids[rows], self.last[rows], -scores))[:k]
                    scored += zip(rows[first].tolist(), map(int, scores[first].tolist()), strict=True)
            scored.sort(key=lambda s: (-s[1], self.last[s[0]], self.ids[s[0]]))
            out.append(scored[:k])
        return out


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double, exactly; null for vectors that
    take no part, and for those whose products pass a double's range."""

    def floored(x: Column) -> Column:
        y = scale * x.cast("double")
        # from 2**53 on a double is a whole number, and a long may not hold it
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return F.when(valid(vector), F.transform(vector, floored))


def search(rows: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "vector", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k rows of the largest inner product.

    Components are whole numbers; ``queries`` has the columns of ``rows``. Null and
    empty vectors and those with null or non-finite components take no part; rows of a
    query's id are no candidates of it, and vectors of another dimension neither. Ties go
    to the smaller id, null last. Repeated queries count once, repeated rows each. With
    fewer candidates than k all are given. Scores are exact for any components; one
    beyond a long counts as the nearest long.
    """
    # Rows that repeat are one candidate that counts up to k times. This reduces before
    # it shuffles, so that however many there are, they don't meet in one shard.
    given = staged(points(rows, key, vector).groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n")), "candidates")
    shards = pieces(given.count(), SHARD_ROWS)
    of = staged(asked(points(queries, key, vector)), "queries")
    blocks = pieces(of.count(), QUERY_BLOCK)

    def look(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        if shard.num_rows and block.num_rows:
            held, asks = Shard(shard), matrix(block["v"])
            names, own_ids = block["q"].to_pylist(), block["id"].to_pylist()
            own = np.array([LEAST + 1 if i is None else i for i in own_ids])
            for i in range(0, len(asks), AT_ONCE):
                for j, first in enumerate(held.best(asks[i : i + AT_ONCE], own[i : i + AT_ONCE], k), i):
                    left = k
                    for row, score in first:
                        out += [(names[j], own_ids[j], held.names[row], score)] * min(left, held.times[row])
                        left = max(0, left - held.times[row])
        kinds = [("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
        return pa.table({n: pa.array([o[i] for o in out], t) for i, (n, t) in enumerate(kinds)})

    shard = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard")
    dealt = given.select("id", "v", "n", F.size("v").alias("dim"), shard)
    placed = dealt.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    grid = ["dim", "shard", "block"]
    found = (
        placed.groupBy(*grid)
        .cogroup(spread(of, shards, blocks).groupBy(*grid))
        .applyInArrow(look, "q long, query_id long, vec_id long, score long")
    )
    return best(found, k)
