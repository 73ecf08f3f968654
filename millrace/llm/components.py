"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour, or to itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternates the two steps, which keep the components, until each node hangs on a
    root. Both reduce by key before they shuffle, and Spark splits the join of a node
    with very many neighbours. Only a count and a checksum come to the driver.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    before = None
    while True:
        now = staged(now, "edges")
        sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = tuple(now.agg(F.count("*"), sums).first())
        if state == before:
            break
        before = state
        now = _small(_large(now)).distinct()
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
