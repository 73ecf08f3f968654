"""Hard negatives by a vertical scan with branch and bound.

A shard stands column by column, one array for each dimension. An anchor reads the
dimensions in descending magnitude of its own components, a few at a time. What the
dimensions not yet read can add to a score lies between bounds that each column's
least and largest entry give. Rows whose bounds can't meet what is asked leave the
bitmap of candidates; of those that stay, the sums are the exact scores at the end.

First the positives are asked for: the best rows of the anchor's label. Their scores
then open a window each, and the best rows of other labels within it are the negatives.
"""

from collections.abc import Callable
from math import floor, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.vectors import matrix, pieces, spread, valid

# Rows of a shard; anchors that go to a shard together.
SHARD_ROWS = 8_192
ANCHOR_BLOCK = 2_048
# Dimensions read between two looks at the bounds.
STEP = 8
# Whole numbers up to here, and their sums, are exact in a double.
EXACT = 2**53
LEAST, MOST = -(2**63), 2**63 - 1

Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly, where the product may pass a double's range."""
    return int(x) * scale if abs(x) >= EXACT else floor(scale * x)


class Columns:
    """A shard's rows, dimension by dimension, as whole numbers.

    Rows with a component so large that sums of products might not be exact in a double
    stand apart, as Python integers.
    """

    def __init__(self, vectors: np.ndarray, scale: int):
        self.scale = scale
        self.most = isqrt(EXACT // max(1, vectors.shape[1]))
        with np.errstate(over="ignore"):
            scaled = np.floor(vectors * scale)
        small = (np.abs(scaled) <= self.most).all(axis=1)
        self.small, self.large = small.nonzero()[0], (~small).nonzero()[0]
        self.columns = np.ascontiguousarray(scaled[small].T)
        empty = not len(self.small)
        self.low, self.high = (np.zeros(len(self.columns)) if empty else f(self.columns, axis=1) for f in (np.min, np.max))
        self.vectors = vectors

    def exact(self, query: np.ndarray, rows: np.ndarray) -> list[int]:
        """Scores of rows; one beyond a long is the nearest long."""
        q = [whole(c, self.scale) for c in query.tolist()]
        sums = (sum(a * whole(b, self.scale) for a, b in zip(q, self.vectors[r].tolist(), strict=True)) for r in rows.tolist())
        return [min(max(s, LEAST), MOST) for s in sums]

    def scores(self, query: np.ndarray, candidate: np.ndarray, keep: Keep) -> list[tuple[int, int]]:
        """(row, exact score) of the candidates that ``keep`` leaves.

        ``keep`` gets the lower and upper bounds of candidates and tells who stays.
        """
        with np.errstate(over="ignore"):
            q = np.floor(query * self.scale)
        if (np.abs(q) > self.most).any():
            rows = candidate.nonzero()[0]
            return list(zip(rows.tolist(), self.exact(query, rows), strict=True))
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.sort(np.stack([self.low * q, self.high * q]), axis=0)[:, order]
        # what is left to come after each dimension
        rest = np.cumsum(ends[:, ::-1], axis=1)[:, ::-1] - ends
        live = candidate[self.small].nonzero()[0]
        total = np.zeros(len(live))
        for start in range(0, len(order), STEP):
            dims = order[start : start + STEP]
            total += q[dims] @ self.columns[np.ix_(dims, live)]
            low, high = rest[:, start + len(dims) - 1]
            stay = keep(total + low, total + high)
            live, total = live[stay], total[stay]
        rows = self.large[candidate[self.large]]
        out = list(zip(self.small[live].tolist(), map(int, total.tolist()), strict=True))
        return out + list(zip(rows.tolist(), self.exact(query, rows), strict=True))


def among_best(k: int) -> Keep:
    """Stays who may be among the ``k`` largest scores."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), bool)
        return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]

    return keep


def in_windows(windows: list[tuple[int, int]], k: int) -> Keep:
    """Stays who may be among the ``k`` largest scores within one of the windows."""

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for low, high in windows:
            inside = lower[(lower >= low) & (upper <= high)]
            least = max(low, np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else low
            stay |= (upper >= least) & (lower <= high)
        return stay

    return keep


def window_of(score: int, least_percent: int) -> tuple[int, int]:
    """The scores s with least_percent * score <= 100 * s <= 100 * score."""
    return -(-least_percent * score // 100), score


class Shard:
    """Rows of a shard in the order of ties: by id, null last."""

    def __init__(self, rows: pa.Table, scale: int):
        rows = rows.sort_by([("id", "ascending")])
        self.ids, self.labels, self.times = (rows[c].to_pylist() for c in ("id", "label", "n"))
        self.columns = Columns(matrix(rows["v"]), scale)
        # numbers that stand for labels, and for ids; a null id equals none
        self.number = {label: i for i, label in enumerate(dict.fromkeys(self.labels))}
        self.label = np.array([self.number[x] for x in self.labels])
        self.place: dict[int, list[int]] = {}
        for i, x in enumerate(self.ids):
            self.place.setdefault(x, []).append(i)

    def others(self, anchor_id: int | None, label, same: bool) -> np.ndarray:
        """The rows of the label, or of all others, without the anchor's own."""
        out = (self.label == self.number.get(label, -1)) == same
        if anchor_id is not None:
            out[self.place.get(anchor_id, [])] = False
        return out

    def first(self, found: list[tuple[int, int]], k: int) -> list[tuple[int | None, int]]:
        """(id, score) of the ``k`` first rows, repeated ones as often as they come."""
        out: list[tuple[int | None, int]] = []
        for row, score in sorted(found, key=lambda f: (-f[1], f[0])):
            out += [(self.ids[row], score)] * min(self.times[row], k - len(out))
            if len(out) == k:
                break
        return out


def positives_in(shard: pa.Table, anchors: pa.Table, scale: int, k: int) -> list[tuple]:
    rows, out = Shard(shard, scale), []
    vectors = matrix(anchors["v"])
    for i, (q, own, label) in enumerate(zip(*(anchors[c].to_pylist() for c in ("q", "id", "label")), strict=True)):
        found = rows.columns.scores(vectors[i], rows.others(own, label, True), among_best(k))
        out += [(q, x, s) for x, s in rows.first(found, k)]
    return out


def negatives_in(shard: pa.Table, anchors: pa.Table, scale: int, k: int, least_percent: int) -> list[tuple]:
    rows, out = Shard(shard, scale), []
    vectors = matrix(anchors["v"])
    for i, (q, own, label, scores) in enumerate(zip(*(anchors[c].to_pylist() for c in ("q", "id", "label", "scores")), strict=True)):
        windows = {s: window_of(s, least_percent) for s in scores}
        found = rows.columns.scores(vectors[i], rows.others(own, label, False), in_windows(list(windows.values()), k))
        for s, (low, high) in windows.items():
            out += [(q, s, x, n) for x, n in rows.first([f for f in found if low <= f[1] <= high], k)]
    return out


def asked_of(shards: DataFrame, anchors: DataFrame, look: Callable, names: list[str]) -> DataFrame:
    """What ``look`` finds for each shard and block of anchors; all columns are longs."""

    def each(shard: pa.Table, block: pa.Table) -> pa.Table:
        out = look(shard, block) if shard.num_rows and block.num_rows else []
        return pa.table({n: pa.array([o[i] for o in out], pa.int64()) for i, n in enumerate(names)})

    grid = ["dim", "shard", "block"]
    return shards.groupBy(*grid).cogroup(anchors.groupBy(*grid)).applyInArrow(each, ", ".join(f"{n} long" for n in names))


def first_of(found: DataFrame, groups: list[str], name: str, score: str, k: int) -> DataFrame:
    """The ``k`` first rows of each group with their ``rank``, by score and then id, null last.

    Spark limits each task's rows to k of a group before it shuffles them.
    """
    order = Window.partitionBy(*groups).orderBy(F.col(score).desc(), F.col(name).asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    key: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(scale * x), a score is an inner product. An anchor's
    positives are its first ``positives`` other rows of its label; for each of them come
    the first ``negatives`` rows of other labels with a score of at least
    ``least_percent`` of the positive's and at most that. Higher scores come first, ties
    by smaller id, null last. ``anchors`` has the columns of ``rows``.

    Null and empty vectors, those with null or non-finite components, and rows with a
    null label take no part; vectors of another dimension don't meet, and rows of an
    anchor's id are no candidates of it. Repeated anchors count once, repeated rows
    each: a positive that comes twice has one window of negatives for each. Scores are
    exact for any finite components; one beyond a long counts as the nearest long.
    """

    def points(of: DataFrame) -> DataFrame:
        usable = valid(F.col(vector)) & F.col(label).isNotNull()
        return of.where(usable).select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))

    most = max(positives, negatives)
    # Rows that repeat are one candidate that counts up to so many times. This reduces
    # before it shuffles, so that however many there are, they don't meet in one shard.
    given = staged(points(rows).groupBy("id", "label", "v").agg(F.least(F.count("*"), F.lit(most)).cast("int").alias("n")), "rows")
    shards = pieces(given.count(), SHARD_ROWS)
    of = staged(points(anchors).distinct().select(F.xxhash64("id", "label", "v").alias("q"), F.size("v").alias("dim"), "id", "label", "v"), "anchors")
    blocks = pieces(of.count(), ANCHOR_BLOCK)
    shard = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard")
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    placed = given.select("*", F.size("v").alias("dim"), shard).select("*", block)

    near = asked_of(
        placed, spread(of, shards, blocks), lambda s, a: positives_in(s, a, scale, positives), ["q", "positive_id", "positive_score"]
    )
    best = staged(first_of(near, ["q"], "positive_id", "positive_score", positives).withColumnRenamed("rank", "place"), "positives")
    # At most ``positives`` scores of each anchor. None below zero has a window.
    scores = best.where("positive_score >= 0").groupBy("q").agg(F.collect_set("positive_score").alias("scores"))
    hard = asked_of(
        placed,
        spread(of.join(scores, "q"), shards, blocks),
        lambda s, a: negatives_in(s, a, scale, negatives, least_percent),
        ["q", "positive_score", "negative_id", "negative_score"],
    )
    ranked = first_of(hard, ["q", "positive_score"], "negative_id", "negative_score", negatives)
    named = best.join(of.select("q", F.col("id").alias("anchor_id")), "q")
    return named.join(ranked, ["q", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
