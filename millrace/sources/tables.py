"""Batch reads: parquet tables, and tables that may not exist yet."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """A frame that the planner knows to be empty: what is joined or united with it is not
    shuffled for its sake, and no worker starts to make it."""
    return spark.range(1).limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows, or none, in the given schema, before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def read_partitions_or_empty(
    spark: SparkSession, path: str, schema: StructType, partition: str, values: Sequence[str]
) -> DataFrame:
    """As ``read_or_empty``, of the given partition values alone. Their folders
    are the only ones listed, however many others the table has."""
    if not values:
        return no_rows(spark, schema)
    folders = f"{path}/{partition}={{{','.join(values)}}}"
    reader = spark.read.schema(schema).option("basePath", path)
    try:
        return reader.parquet(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(conf)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders directly under ``path``; none if that is missing."""
    at, fs = _path(spark, path)
    if not fs.exists(at):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory())


def bytes_under(spark: SparkSession, path: str) -> int:
    at, fs = _path(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def remove_folder(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def table_list(spark: SparkSession, path: str) -> DataFrame:
    """A list of table names. Called per batch, it follows the stored list."""
    return read_or_empty(spark, path, StructType().add("table", "string"))
