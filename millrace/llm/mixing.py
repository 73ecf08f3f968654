"""Mixing sources to target weights.

Words are summed by source, each source gets a target and with it a repetition
rate; a document comes floor(rate) times, and once more with the probability of
the fraction, decided by a hash of its id. Reruns give the same mix.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import free_name, staged, without, word_count

WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
# Sources up to this many are broadcast with their rates: some MB at most.
BROADCAST_SOURCES = 50_000
OWN = ["size", "source_size", "weight", "target", "rate", "copies"]


def chance(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key's text and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(2**48))


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, have the weights in turn. They share the
    total by weight. A source stops at ``most`` times its size; what it leaves is
    shared by the others. All sources that stop have the smallest ratios of size to
    weight, so one pass over the sources in that order finds the level at which the
    rest share. The windows run over sources, one row each, not over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.lit(list(weights)), turn + 1).cast("long"))
    # cap_a / w_a < cap_b / w_b as whole numbers would need a join; the quotient is
    # the same double for equal ratios, and ties end on the same side of the level.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    summed = (
        weighed.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
        .withColumn("capped", F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    # The level if this source is the first that doesn't stop.
    level = (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("gone"))
    fits = level * F.col("weight") <= (F.lit(most) * F.col("source_size")).cast("double")
    levelled = summed.withColumn("level", F.min(F.when(fits, F.struct("gone", level.alias("level")))).over(whole)["level"])
    share = F.col("level") * F.col("weight")
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    return levelled.select(
        "source",
        "source_size",
        "weight",
        F.coalesce(F.least(share, cap), cap, F.lit(0.0)).alias("target"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    most: int = MOST_TIMES,
    seed: int = 42,
) -> DataFrame:
    """All rows and columns, with size, source_size, weight, target, rate and copies.

    ``copies`` is how often the mix takes the row, 0 included. A null text counts 0
    words; null sources are one source; a null key counts as the empty text, so such
    rows share one draw. Repeated rows are decided alike. A source without words has
    target and rate 0. Documents are not shuffled unless there are more than
    BROADCAST_SOURCES sources: then they join the rates by source, where Spark splits
    large sources. Columns of these names are replaced; others can have any names.
    """
    rows = without(docs, OWN)
    sizes = rows.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(F.col(text))).alias("source_size"))
    # one row for each source, read twice: here to be counted, and for the join
    rates = staged(targets(sizes, weights, most), "targets").withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    of = free_name("of", rows.columns)
    rates = rates.withColumnRenamed("source", of)
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    whole = F.floor("rate")
    extra = (chance(F.col(key), seed) < F.col("rate") - whole).cast("long")
    return (
        rows.withColumn("size", word_count(F.col(text)))
        .join(rates, F.col(source).eqNullSafe(F.col(of)))
        .drop(of)
        .withColumn("copies", whole + extra)
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, without the columns that mix() added."""
    each = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    copy = free_name("copy", mixed.columns)
    return mixed.select("*", each.alias(copy)).drop(copy, *OWN)
