"""One row per key, as aggregations: each task first reduces its own rows, so
a key that holds a third of the input still crosses the shuffle as one row per
task. Picking a whole row is a sort-based aggregation: each task sorts its own
rows by key, spilling to disk if it must, before and after the shuffle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = choose(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row lowest in ``order`` for each key."""
    return _pick(df, keys, order, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row highest in ``order`` for each key: the last write wins."""
    return _pick(df, keys, order, F.max_by)


def _extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = choose(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def lowest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As ``first_per_key``, with the other columns settling ties. Each column crosses the
    shuffle once, not once to be kept and once more to be compared."""
    return _extreme(df, keys, order, F.min)


def highest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As ``latest_per_key``, in the way of ``lowest_per_key``."""
    return _extreme(df, keys, order, F.max)


def end_offsets(messages: DataFrame) -> DataFrame:
    """Per topic partition, the offset after the last one read."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset")
    )
