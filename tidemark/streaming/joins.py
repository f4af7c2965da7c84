"""Two-stream join under disorder (J3, the reference's open TODO).

Both sides get a watermark; the join condition bounds the time distance, so
Spark can expire state on both sides instead of keeping every row forever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.watermark import WatermarkSpec, event_ts


def interval_join(
    left: DataFrame, right: DataFrame, key: str, spec: WatermarkSpec, max_gap_ms: int,
    ts: str = "time_stamp", how: str = "inner",
) -> DataFrame:
    """Rows of ``left`` and ``right`` with equal ``key`` and ``|ts_l - ts_r| <= max_gap_ms``."""
    lt = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns]).withColumn("l_event_ts", event_ts(f"l_{ts}"))
    rt = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumn("r_event_ts", event_ts(f"r_{ts}"))
    lt = lt.withWatermark("l_event_ts", spec.streaming_delay)
    rt = rt.withWatermark("r_event_ts", spec.streaming_delay)
    gap = F.expr(f"INTERVAL {max_gap_ms} MILLISECONDS")
    cond = (
        (F.col(f"l_{key}") == F.col(f"r_{key}"))
        & (F.col("r_event_ts") >= F.col("l_event_ts") - gap)
        & (F.col("r_event_ts") <= F.col("l_event_ts") + gap)
    )
    return lt.join(rt, cond, how)
