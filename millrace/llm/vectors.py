"""What the two vector searches share: valid vectors, a grid of shards and query blocks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """Neither null nor empty, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def points(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows whose vectors are valid."""
    return rows.where(valid(F.col(vector))).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def asked(of: DataFrame) -> DataFrame:
    """(q, dim, id, v): queries, each different (id, v) once; q tells them apart."""
    return of.distinct().select(
        F.xxhash64(F.col("id"), F.col("v")).alias("q"), F.size("v").alias("dim"), "id", "v"
    )


def pieces(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def spread(queries: DataFrame, shards: int, blocks: int) -> DataFrame:
    """Each query once for each shard, in its block: rows for a cogroup by (dim, shard, block)."""
    block = F.pmod(F.col("q"), F.lit(blocks)).cast("int").alias("block")
    return queries.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """A row for each list; all have one length."""
    flat = lists.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query, ties to the smaller id.

    ``found`` has (q, query_id, vec_id, score) of all shards. Spark limits each task's
    rows to k of a query before it shuffles them.
    """
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
