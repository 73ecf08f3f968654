"""What several operators share: written intermediate tables, Arrow batches, names."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_folder, tune

# Rows of an Arrow batch. A batch of whole texts has to fit in a Python worker.
ARROW_ROWS = "512"

# What the contracts call a word, in Java's, Python's and RE2's syntax alike.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings that the operators of this package assume."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, not what led to the
    table, and two readers of the table don't compute it twice.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without columns of these names, in whatever case they are spelled."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def free_name(name: str, taken: Iterable[str]) -> str:
    """A name for a column of our own that no given column has, in whatever case."""
    used = {t.lower() for t in taken}
    return next(n for n in (f"_{name}{i}" for i in range(len(used) + 1)) if n not in used)


def replaced(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
