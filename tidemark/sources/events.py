"""Adapters from the driver's ``events`` table to the reference's row types.

``events(event_id, ts, user_id, event_type, value, props)`` arrives in event
time order.  The reference's jobs are about disorder, so an arrival order
``seq`` is derived deterministically from ``event_id`` (a bounded shuffle of up
to 96 positions).  ``seq`` is a per-row expression - no global sort - that is
unique and ordered exactly like
``row_number() over (order by event_id + (event_id*7919) % 97, event_id)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.watermark import epoch_ms

# Arrival shuffle of the events adapter.
SHIFT_MUL = 7919
SHIFT_MOD = 97
# seq = (event_id + shift) * SEQ_SCALE + (SHIFT_MOD - 1 - shift); shift < SHIFT_MOD <= SEQ_SCALE
SEQ_SCALE = 128

# Event types that stand for the four process steps; 'error' is noise.
STEP_OF_EVENT = {"view": "step1", "click": "step2", "signup": "step3", "purchase": "step4"}
STEPS = ("step1", "step2", "step3", "step4")
# Steps 1 and 3 come from station 1, steps 2 and 4 from station 2; noise from station 1.
STATION_OF_STEP = {"step1": 1, "step2": 2, "step3": 1, "step4": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrival_seq(event_id: str | Column = "event_id") -> Column:
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    shift = F.pmod(e * F.lit(SHIFT_MUL), F.lit(SHIFT_MOD))
    return (e + shift) * F.lit(SEQ_SCALE) + (F.lit(SHIFT_MOD - 1) - shift)


def _content() -> Column:
    c = F.lit("error")
    expr = None
    for ev, step in STEP_OF_EVENT.items():
        expr = (F.when if expr is None else expr.when)(F.col("event_type") == ev, F.lit(step))
    return expr.otherwise(c)


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SensorReading rows: ``id string, time_stamp bigint, temperature double`` + ``seq, event_id``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("id"),
        epoch_ms("ts").alias("time_stamp"),
        F.col("value").alias("temperature"),
        arrival_seq().alias("seq"),
    )


def sensor_lines(spark: SparkSession, sf_dir: str, keep_ts: bool = False) -> DataFrame:
    """Raw CSV lines ``id,time_stamp,temperature`` as a socket would deliver them.

    ``keep_ts`` also keeps the source ``ts`` column (e.g. for time buckets).
    """
    ev = table(spark, sf_dir, "events")
    r = ev.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").cast("string").alias("id"),
        epoch_ms("ts").alias("time_stamp"),
        F.col("value").alias("temperature"),
        arrival_seq().alias("seq"),
    )
    return r.select(
        "event_id",
        "seq",
        *(["ts"] if keep_ts else []),
        F.concat_ws(",", "id", F.col("time_stamp").cast("string"), F.col("temperature").cast("string")).alias(
            "value"
        ),
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LogEvent rows: ``id, workpiece, time_stamp, content`` + ``station, seq, event_id``."""
    ev = table(spark, sf_dir, "events")
    content = _content()
    station = F.when(content.isin("step2", "step4"), F.lit(2)).otherwise(F.lit(1))
    return ev.select(
        F.col("event_id"),
        F.concat(F.lit("workStation_"), station.cast("string")).alias("id"),
        F.col("user_id").cast("string").alias("workpiece"),
        epoch_ms("ts").alias("time_stamp"),
        content.alias("content"),
        station.alias("station"),
        arrival_seq().alias("seq"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines ``id, workpiece, time_stamp, content`` (blanks after commas, as in the sample)."""
    e = log_events(spark, sf_dir)
    return e.select(
        "event_id",
        "seq",
        "station",
        F.concat_ws(", ", "id", "workpiece", F.col("time_stamp").cast("string"), "content").alias("value"),
    )
