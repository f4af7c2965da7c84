"""Small inputs of the reference's sample files and hand-derived expectations (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parse import QUARANTINE, parse_log_lines, parse_sensor_lines

BASE = 1_000_000_000_000

# The two blocks of the sample sensor file as (second, temperature).
B1 = [(0, 2), (5, 9), (10, 3), (2, 10), (4, 9), (5, 8), (15, 11), (4, 11), (20, 7)]
B2 = [(10, 3), (4, 9), (5, 8), (3, 7), (20, 8)]

# The sample process log (station 1) and our authored station 2.
L2 = [("workStation_1", "wp1", 0, "step1"), ("workStation_1", "wp1", 3000, "step3"),
      ("workStation_1", "wp1", 5000, "step1"), ("workStation_1", "wp1", 7000, "step3")]
L1 = [("workStation_2", "wp1", 1000, "step2"), ("workStation_2", "wp1", 4000, "step4"),
      ("workStation_2", "wp1", 6000, "step2"), ("workStation_2", "wp1", 8000, "step4")]

STEPS = ("step1", "step2", "step3", "step4")


def sensor_block(spark: SparkSession, block) -> DataFrame:
    """Lines of one block in arrival order, parsed; ``event_id`` = ``seq`` = line number."""
    lines = [(i + 1, f"sensor1,{BASE + s * 1000},{t}") for i, (s, t) in enumerate(block)]
    df = spark.createDataFrame(lines, "seq long, value string").withColumn("event_id", F.col("seq"))
    rows, bad = parse_sensor_lines(df, mode=QUARANTINE)
    assert bad.count() == 0
    return rows


def log_events(spark: SparkSession, rows) -> DataFrame:
    """Log lines merged by time; ``seq`` 1..n, station from the id."""
    ordered = sorted(rows, key=lambda r: r[2])
    lines = [(i + 1, f"{a}, {b}, {BASE + t}, {c}") for i, (a, b, t, c) in enumerate(ordered)]
    df = spark.createDataFrame(lines, "seq long, value string").withColumn("event_id", F.col("seq"))
    parsed, bad = parse_log_lines(df, mode=QUARANTINE)
    assert bad.count() == 0
    return parsed.withColumn("station", F.when(F.col("id") == "workStation_2", 2).otherwise(1))


def secs(ms_values) -> list:
    return [None if v is None else (v - BASE) // 1000 for v in ms_values]
