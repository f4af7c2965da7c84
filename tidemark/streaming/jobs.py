"""End-to-end streaming jobs, over streams stamped with their exact watermark (``stamping``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.jobs import step_pattern
from tidemark.operators import sequence as C
from tidemark.operators import zipjoin as Z
from tidemark.streaming import pattern as P
from tidemark.streaming import stateful as ST

#: Order of the zipped rows: event time of the trigger, its arrival, the step.
ZIPPED_ORDER = ("trigger_ts", "trigger_seq", "pos")


def zipped_rows(stamped: DataFrame, steps: Sequence[str], idle_ttl_ms: int | None, key: str = "workpiece") -> DataFrame:
    """Keyed FIFO zip with idle TTL; its rows carry the time and stamps of the event that completed them."""
    tuples = ST.zip_stream(
        stamped, key, steps, idle_ttl_ms, idle=idle_ttl_ms is not None, clock="clock_ms" if idle_ttl_ms is not None else None,
        item_cols=["content"], carry=["wm_ms", "after_ms"],
    )
    rows = Z.emit_rows(tuples, key, steps, carry=["trigger_wm_ms", "trigger_after_ms"], item_cols=["content"])
    return rows.withColumn("row_ts", F.col("time_stamp"))


def select_tracked(matches: DataFrame, steps: Sequence[str], key: str = "workpiece") -> DataFrame:
    """(name, time) of every step and the number of events, as the select function returns them."""
    n_events = sum((F.col(f"{s}_row_ts").isNotNull().cast("bigint") for s in steps), F.lit(0).cast("bigint"))
    return matches.select(
        F.col(f"{steps[0]}_{key}").alias(key),
        *[x for s in steps for x in (F.lit(s).alias(f"{s}_name"), F.col(f"{s}_row_ts").alias(f"{s}_ts"))],
        n_events.alias("n_events"),
    )


def track_process_stream(stamped: DataFrame, steps: Sequence[str], idle_ttl_ms: int | None, key: str = "workpiece") -> DataFrame:
    """Process tracking (C8) as one query of two chained stateful operators, the pattern per ``key``.

    The zip passes its watermark on; the pattern's timers stand at the triggers' event times.
    The form whose pattern has no key runs ``zipped_rows`` into ``global_pattern.GlobalPattern``.
    """
    rows = C.drop_late(zipped_rows(stamped, steps, idle_ttl_ms, key), ts="trigger_ts", wm="trigger_wm_ms")
    rows = rows.withColumn("__key", F.col(key))
    matches = P.match_stream(
        rows, step_pattern(steps), "__key", ts=ZIPPED_ORDER[0], order=ZIPPED_ORDER[1:], payload=["row_ts", key]
    )
    return select_tracked(matches, steps, key)
