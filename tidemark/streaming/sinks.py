"""Sinks (K1-K8): printed rows, row-text files with time buckets and rolling.

The file sink is Spark's: each micro-batch commits its part files atomically
through the ``_spark_metadata`` log under the output path, which gives the
in-progress -> pending -> finished lifecycle of the reference's comment, and
the checkpoint makes it exactly-once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Bucket directory layout and the rolling policy of the file sink.
BUCKET_FORMAT = "yyyy-MM-dd--HH"
ROLL_INTERVAL = "2 minutes"
MAX_PART_BYTES = 10 * 1024 * 1024
#: Bytes that a row counts as where nothing is known about its length.
ROW_BYTES = 64


def with_bucket(df: DataFrame, ts: Column | None = None, out: str = "bucket") -> DataFrame:
    """K4: hourly bucket of ``ts`` (processing time when omitted)."""
    t = ts if ts is not None else F.current_timestamp()
    return df.withColumn(out, F.date_format(t, BUCKET_FORMAT))


def records_per_file(df: DataFrame | None = None, value: str = "value", max_bytes: int = MAX_PART_BYTES,
                     row_bytes: int = ROW_BYTES) -> int:
    """K6 size roll: rows of at most ``max_bytes``.

    Without ``df`` a row counts as ``row_bytes`` (an upper estimate, no pass over the data);
    with it, as the mean of its encoded rows (one aggregate job).
    """
    mean = row_bytes
    if df is not None:
        mean = df.agg(F.avg(F.octet_length(F.col(value)) + F.lit(1)).alias("m")).first()["m"] or row_bytes
    return max(1, int(max_bytes // mean))


def write_text_buckets(df: DataFrame, path: str, bucket: str | None = "bucket", value: str = "value",
                       max_records: int | None = None) -> None:
    """Batch form of the bucketed row-text sink (K3-K6); ``bucket=None`` is one global bucket.

    One pass over the input: rows are rebalanced by bucket, so a task writes few buckets, and
    adaptive execution splits a bucket that is larger than a task by the sizes it has shuffled.
    Files roll at ``max_records`` rows (default: MAX_PART_BYTES of ROW_BYTES rows).
    """
    if bucket:
        df = df.hint("rebalance", bucket)
    w = df.select(value, *([bucket] if bucket else [])).write.mode("append")
    w = w.option("maxRecordsPerFile", str(max_records or records_per_file()))
    if bucket:
        w = w.partitionBy(bucket)
    w.text(path)


def text_file_sink(
    df: DataFrame, path: str, checkpoint: str, bucket: str | None = "bucket", value: str = "value",
    max_records: int | None = None, trigger: str = ROLL_INTERVAL,
) -> DataStreamWriter:
    """Streaming row-text sink: one roll per micro-batch (age/inactivity = trigger), and a roll by
    size within it (K6): ``max_records`` rows, by default MAX_PART_BYTES of ROW_BYTES rows."""
    w = (
        df.select(value, *([bucket] if bucket else []))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=trigger)
    )
    w = w.option("maxRecordsPerFile", str(max_records or records_per_file()))
    if bucket:
        w = w.partitionBy(bucket)
    return w


def print_sink(df: DataFrame, label: str | None = None, checkpoint: str | None = None) -> DataStreamWriter:
    """K1/K2: console output; the label becomes the query name."""
    w = df.writeStream.format("console").option("truncate", "false").outputMode("append")
    if label:
        w = w.queryName(label)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w
