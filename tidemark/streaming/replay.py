"""Ordered folders: tables that a file stream reads back in arrival order.

Spark's file source takes new files by modification time.  ``write_ordered`` cuts rows into
files by ranges of an order column, gives the files ascending times and only then puts the
folder in place by one rename, so a reader sees all of its files or none, and
``maxFilesPerTrigger`` cuts the stream at places of the arrival order.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "org.apache.spark.sql.execution.streaming.state"
_STARTING = threading.Lock()


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, at = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def write_ordered(df: DataFrame, order: str, path: str, files: int | None = None, after_ms: int = 0) -> int:
    """Write ``df`` as a folder of files that are contiguous and ascending in ``order``.

    Files get modification times above ``after_ms`` and ascending; the largest is returned.
    ``files`` is the number of ranges (by default Spark's, merged by size).  A folder that exists
    already is not written again; an attempt that was cut off leaves a hidden folder, which
    readers skip and the next attempt overwrites.
    """
    spark = df.sparkSession
    if exists(spark, path):
        return after_ms
    ranged = df.repartitionByRange(files, order) if files else df.repartitionByRange(order)
    parent, name = path.rstrip("/").rsplit("/", 1)
    staging = f"{parent}/.staging-{name}"
    ranged.sortWithinPartitions(order).write.mode("overwrite").parquet(staging)
    fs, at = _file_system(spark, staging)
    listed = [s for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")]
    last = max(int(time.time() * 1000), after_ms)
    for status in sorted(listed, key=lambda s: s.getPath().getName()):
        last += 1
        fs.setTimes(status.getPath(), last, -1)
    _, target = _file_system(spark, path)
    if not fs.rename(at, target):
        raise OSError(f"could not put {path} in place")
    return last


def read_ordered(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 1,
                 bytes_per_trigger: int | None = None) -> DataFrame:
    """Stream of an ordered folder (or of a folder of such folders).

    A micro-batch takes ``files_per_trigger`` files or, if given, as many as ``bytes_per_trigger`` hold.
    """
    most = {"maxFilesPerTrigger": files_per_trigger} if bytes_per_trigger is None else {"maxBytesPerTrigger": bytes_per_trigger}
    return spark.readStream.schema(schema).options(**most).option("recursiveFileLookup", "true").parquet(path)


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside get a state store that can hold several state variables per key.

    Spark's default one holds a single variable.  A query copies the settings of its session when it
    starts, so the session has its own back afterwards; a provider of the caller's choice stays.
    """
    with _STARTING:
        own = spark.conf.get(PROVIDER, None)
        if own not in (None, f"{_STATE}.HDFSBackedStateStoreProvider"):
            yield
            return
        spark.conf.set(PROVIDER, f"{_STATE}.RocksDBStateStoreProvider")
        try:
            yield
        finally:
            if own is None:
                spark.conf.unset(PROVIDER)
            else:
                spark.conf.set(PROVIDER, own)


def run_available(writer: DataStreamWriter, checkpoint: str, spark: SparkSession | None = None) -> None:
    """Run a query over all that is available, to its end; raises what the query raises.

    ``spark`` is the session of the stream, by default the active one.
    """
    with state_store(spark or SparkSession.active()):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
