"""Sharding: a permutation-filled lookup table places keys in constant time.

Each shard orders all slots of a prime-sized table by its own permutation. The
shards take turns, each claiming the first slot of its order that is free, until
none is. So every shard has as many slots as another, give or take one, and when
a shard leaves, few slots besides its own change hands.
"""

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import without

# The table is sent to every executor; beyond this many slots it is refused.
MOST_SLOTS = 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def order_of(shard: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's walk over the slots."""
    h = md5(shard.encode()).hexdigest()
    return int(h[:8], 16) % slots, int(h[8:16], 16) % (slots - 1) + 1


def fill(shards: list[str], slots: int) -> list[int]:
    """The shard, by its place in the list, of each slot.

    Bounded by ``slots`` on the driver: a setting of the operator, not data.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards: one or more different names")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots: a prime of at least {len(shards)} and at most {MOST_SLOTS}")
    walks = [order_of(s, slots) for s in shards] if slots > 2 else [(0, 1)] * len(shards)
    owner, place = [-1] * slots, [0] * len(shards)
    for turn in range(slots):
        i = turn % len(shards)
        start, step = walks[i]
        while owner[(start + place[i] * step) % slots] >= 0:
            place[i] += 1
        owner[(start + place[i] * step) % slots] = i
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard): at most MOST_SLOTS rows."""
    owners = F.lit(fill(shards, slots))
    names = F.array(*[F.lit(s) for s in shards])
    return spark.range(1).select(F.posexplode(owners).alias("slot", "owner")).select(
        "slot", F.element_at(names, F.col("owner") + 1).alias("shard")
    )


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key by its text; null keys share the slot of the empty text."""
    first = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(first, 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int) -> DataFrame:
    """All rows and columns, with ``slot`` and ``shard``; no row is moved or lost.

    The same key has the same shard in every row, run and table. Columns called
    slot or shard are replaced.
    """
    rows = without(df, ["slot", "shard"]).withColumn("slot", slot_of(F.col(key), slots))
    return rows.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot")
