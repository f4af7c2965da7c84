"""Line-oriented sources (S1-S6) for batch and Structured Streaming.

No network connection is opened here: the socket and Kafka readers only
configure ``spark.readStream``; the query that starts them owns the connection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader


def socket_reader(spark: SparkSession, host: str, port: int) -> DataStreamReader:
    """One row per line read from a TCP socket (``value string``)."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port))


def kafka_options(topic: str, bootstrap_servers: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options of a Kafka topic of UTF-8 string values."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "startingOffsets": "earliest"}
    opts.update(extra or {})
    return opts


def kafka_reader(spark: SparkSession, topic: str, bootstrap_servers: str, extra=None) -> DataStreamReader:
    """Needs the spark-sql-kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(topic, bootstrap_servers, extra))


def kafka_values(raw: DataFrame) -> DataFrame:
    """String deserialisation; ``(partition, offset)`` is the arrival order."""
    return raw.select(
        F.col("value").cast("string").alias("value"), F.col("partition"), F.col("offset"), F.col("timestamp")
    )


def paced_file_reader(spark: SparkSession, files_per_trigger: int = 1) -> DataStreamReader:
    """Replay of a directory of line files, ``files_per_trigger`` files per
    micro-batch; the pacing itself is the query's ``trigger(processingTime=...)``."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", str(files_per_trigger))


def text_file(spark: SparkSession, path: str) -> DataFrame:
    """Batch text scan, one row per line."""
    return spark.read.text(path)


def from_collection(spark: SparkSession, rows: Iterable[tuple], schema: str = "_1 string, _2 int") -> DataFrame:
    """S3: a small in-memory collection (driver data by nature)."""
    return spark.createDataFrame(list(rows), schema)


def first_field(pairs: DataFrame) -> DataFrame:
    """``map(Tuple2::_1)`` with a string type hint."""
    return pairs.select(F.col("_1").cast("string").alias("_1"))
