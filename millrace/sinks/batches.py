"""Keyed tables fed by micro-batches.

A table is a parquet folder partitioned by one column of its rows and by the
batch that wrote them. A batch only ever writes its own partitions, so a batch
run again replaces what its first attempt left, and nothing else is touched:
the cost of an upsert is the size of the batch, not of the day it lands in.
Reading keeps the row written last for each key.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from millrace.operators.keyed import highest_per_key
from millrace.schemas import plus
from millrace.session import settings
from millrace.sources.tables import read_or_empty, read_partitions_or_empty

BATCH = "batch"
# For a write straight from the tasks of a large batch: a task keeps open a file for each value
# it meets, where it would else sort, and spill, its rows; row groups are small, so that the
# open files fit in memory; and what was shuffled to make the rows goes when they are stored.
UNSORTED = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
ROW_GROUP_BYTES = 16 << 20


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """A name for a micro-batch, the same whenever it is repeated. Numbers
    start over with a new checkpoint, so the query's own id is part of it."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def write_batch(rows: DataFrame, batch: str, path: str, partition: str, shuffled: bool = True) -> None:
    """Store the rows of one batch; an empty batch writes nothing.

    The rebalance hint gives each partition value few, evenly sized files and
    still splits the one value that most rows usually share, such as today. For rows
    of few values that lie in even tasks as it is, ``shuffled=False`` spares that:
    each task then writes a file for each value it has, as its rows come.
    """
    spark = rows.sparkSession
    rows = rows.withColumn(BATCH, F.lit(batch))
    with settings(spark, {} if shuffled else UNSORTED):
        writer = (rows.hint("rebalance", partition) if shuffled else rows).write.mode("overwrite")
        if not shuffled:
            writer = writer.option("parquet.block.size", ROW_GROUP_BYTES)
        (
            writer.option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(partition, BATCH)
            .parquet(path)
        )


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored rows with the batch that wrote them, every version of a key."""
    return read_or_empty(spark, path, plus(schema, batch=StringType()))


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, partition: str, values: Sequence[str]
) -> DataFrame:
    """As ``read_batches``, of the given partition values alone."""
    return read_partitions_or_empty(spark, path, plus(schema, batch=StringType()), partition, values)


def read_latest(
    spark: SparkSession,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The current row of each key: the highest in ``order``, of equal ones the highest in
    the other columns. With ``columns``, these alone: a column that is neither asked for
    nor compared is not read."""
    names = schema.fieldNames() if columns is None else list(columns)
    wanted = [f for f in schema.fieldNames() if f in (*names, *keys, *order)]
    rows = read_batches(spark, path, schema).select(*wanted)
    return highest_per_key(rows, keys, order).select(*names)

