"""Session settings and the shared work folder."""

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates are cut from epoch ms in this zone, whatever the machine's zone is.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stream state beyond the executors' memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for what is planned or started within."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """Of this process; removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="millrace-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for one run, under the folder the cluster names.

    A local session may lack that setting and then works in a temporary folder.
    On a cluster no executor would see such a folder, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder().name
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"
