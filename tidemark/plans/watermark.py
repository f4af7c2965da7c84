"""Event time and watermarks on static (batch) data.

The streaming reference advances its watermark as records arrive.  On a table
we reproduce the same decision for every row by stamping it with the watermark
that was in force when it arrived (its arrival order is the ``seq`` column):

    wm_before(row) = max(ts of rows with smaller seq) - delay - (1 if minus_one)

NULL for the first row, which means "nothing is late yet".  The running max is
a distributed two-phase prefix scan (``plans.scan``), never one global window.
When several streams are unioned, each stream keeps its own running max and the
watermark of the union is the minimum of them, NULL until every stream has
produced a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scan import OrderStats, scan

# Epoch of TIMESTAMP_NTZ values; differences against it are zone independent.
_EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_ms(col: str | Column) -> Column:
    """Event time assigner: a timestamp / timestamp_ntz column as epoch milliseconds."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MILLISECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def event_ts(ms: str | Column) -> Column:
    """Epoch milliseconds as a Spark TIMESTAMP (what ``withWatermark`` needs)."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


@dataclass(frozen=True)
class WatermarkSpec:
    """How far the watermark trails the largest event time seen so far.

    ``minus_one`` reproduces the built-in strategies, which subtract one more
    millisecond; a hand-written generator emitting ``max - delay`` sets it False.
    """

    delay_ms: int
    minus_one: bool = True

    @property
    def lag_ms(self) -> int:
        return self.delay_ms + (1 if self.minus_one else 0)

    @property
    def streaming_delay(self) -> str:
        """Delay string for ``withWatermark``: Spark closes a window when
        ``max - delay >= end``, i.e. ``max - delay - 1 >= end - 1``."""
        return f"{self.lag_ms - 1} milliseconds"


def bounded_out_of_orderness(delay_ms: int) -> WatermarkSpec:
    return WatermarkSpec(delay_ms, True)


def monotonous() -> WatermarkSpec:
    return WatermarkSpec(0, True)


def periodic_generator(delay_ms: int) -> WatermarkSpec:
    """A custom generator that emits ``max - delay`` (no extra millisecond)."""
    return WatermarkSpec(delay_ms, False)


def stamp_watermark(
    df: DataFrame,
    spec: WatermarkSpec,
    ts: str = "ts_ms",
    order: str = "seq",
    out: str = "wm_ms",
    stream: str | None = None,
    streams: Sequence[object] = (),
    stats: OrderStats | None = None,
    clock: str | None = None,
) -> DataFrame:
    """Add ``out``: the watermark in force when each row arrived.

    With ``stream``/``streams`` the input is a union of several sources and the
    watermark is the minimum over the sources' own watermarks.  ``clock`` also
    adds the inclusive running max of event time over all sources (a monotone
    arrival clock) from the same scan.
    """
    if stream is None:
        stamped = scan(df, [order], {"__pm": ("max", F.col(ts))}, stats=stats)
        if clock:
            stamped = stamped.withColumn(clock, F.greatest(F.col("__pm"), F.col(ts)))
        return stamped.withColumn(out, F.col("__pm") - F.lit(spec.lag_ms)).drop("__pm")
    names = [f"__pm{i}" for i in range(len(streams))]
    aggs = {
        n: ("max", F.when(F.col(stream) == F.lit(s), F.col(ts))) for n, s in zip(names, streams)
    }
    stamped = scan(df, [order], aggs, stats=stats)
    any_missing = F.lit(False)
    for n in names:
        any_missing = any_missing | F.col(n).isNull()
    lowest = F.least(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    wm = F.when(any_missing, F.lit(None)).otherwise(lowest)
    if clock:
        stamped = stamped.withColumn(clock, F.greatest(*[F.col(n) for n in names], F.col(ts)))
    return stamped.withColumn(out, wm - F.lit(spec.lag_ms)).drop(*names)


def running_max(
    df: DataFrame, ts: str = "ts_ms", order: str = "seq", out: str = "clock_ms",
    stats: OrderStats | None = None,
) -> DataFrame:
    """Inclusive running max of event time in arrival order (a monotone arrival clock)."""
    return scan(df, [order], {out: ("max", F.col(ts))}, inclusive=True, stats=stats)
