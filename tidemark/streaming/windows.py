"""Structured Streaming forms of the window jobs.

* ``stream_window_aggregate`` - the plain path: ``withWatermark`` +
  ``groupBy(window)`` in append mode.  Spark advances the watermark once per
  micro-batch, so it admits a late row that arrives in the batch right after
  the row that made it late (one batch of lag), and append mode never flushes
  the last open windows when input ends (add a sentinel row, see
  ``flush_sentinel_ms``).
* ``ExactLateness`` - the exact path: a ``foreachBatch`` function that stamps every
  row with the watermark in force when it arrived (``stamping``) and labels it with the
  same batch code as ``operators.windows``.  Main and late rows are written per
  ``batch_id`` (overwrite of that batch's folder), so a retried batch is idempotent.
* ``apply_window_stream`` - windows that fire (W2, W3, A1, O1): rows of a (key, window) wait in
  list states by time slice; an event-time timer at the window's end hands them, in event-time
  order, to the user's function, slice after slice, and clears them.
* ``refire_panes_stream`` - bounded re-fire (L2): one small aggregate per (key, window) that
  lives until the window's end plus the allowed lateness; every allowed-late row emits a pane.

The last two run over ``stamping.stamped_stream``: its watermark is the exact one, and the stamps
say which rows are late, so they equal the batch operators whatever the micro-batches are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.operators import windows as W
from tidemark.plans.watermark import WatermarkSpec, event_ts
from tidemark.streaming.shared import transform_with_state
from tidemark.streaming.stamping import WatermarkStamper

#: Time slices of a window's rows; a window that fires holds one slice in memory.
SLICES = 8


def stream_window_aggregate(
    readings: DataFrame, spec: WatermarkSpec, size_ms: int, key: str = "id", ts: str = "time_stamp",
    value: str = "temperature",
) -> DataFrame:
    """Plain path: append-mode per-(key, window) aggregates of a streaming DataFrame."""
    timed = readings.withColumn("event_ts", event_ts(ts)).withWatermark("event_ts", spec.streaming_delay)
    agg = timed.groupBy(key, F.window("event_ts", f"{size_ms} milliseconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("sum_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    )
    return agg.select(
        key, F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end"),
        "n_rows", "sum_value", "min_value", "max_value",
    )


def flush_sentinel_ms(max_ts_ms: int, spec: WatermarkSpec, size_ms: int, lateness_ms: int = 0) -> int:
    """An event time whose arrival closes every window ending at or before ``max_ts_ms``."""
    return max_ts_ms + size_ms + lateness_ms + spec.lag_ms + 1


class ExactLateness(WatermarkStamper):
    """``foreachBatch`` function with record-level watermark semantics (L1-L3).

    Writes ``<out>/main/batch_id=N`` (on-time and allowed-late rows, labelled),
    ``<out>/late/batch_id=N`` (side output) and ``<out>/_max/batch_id=N`` (the
    running max event time of every source after batch N, the carry of batch
    N+1).  With ``stream``/``streams`` the input is a union of sources and the
    watermark is the minimum of the sources' own, NULL until each has a row.
    """

    def __init__(self, out: str, spec: WatermarkSpec, size_ms: int, lateness_ms: int = 0,
                 ts: str = "time_stamp", order: str = "seq", stream: str | None = None, streams=()):
        super().__init__(out, spec, ts, order, stream, streams)
        self.size_ms, self.lateness_ms = size_ms, lateness_ms

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()  # read several times, from the source once
        try:
            carry = self.maxima.before(spark, batch_id)
            stamped = self.stamp(batch, carry).drop("after_ms", "clock_ms")
            labelled = W.label_lateness(stamped, self.size_ms, self.lateness_ms, ts=self.ts)
            row = batch.agg(*[F.max(self._value(s)).alias(f"m{i}") for i, s in enumerate(self.streams)]).first()
            best = [max((v for v in (c, row[f"m{i}"]) if v is not None), default=None) for i, c in enumerate(carry)]
            W.emitted_rows(labelled).write.mode("overwrite").parquet(f"{self.out}/main/batch_id={batch_id}")
            W.late_side_output(labelled).write.mode("overwrite").parquet(f"{self.out}/late/batch_id={batch_id}")
            self.maxima.write(spark, batch_id, best)
        finally:
            batch.unpersist()

    def main_rows(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.out}/main")

    def late_rows(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.out}/late")

    def panes(self, spark, key: str, value: str, row_id: str = "event_id") -> DataFrame:
        """Re-fire panes (L2) of everything written so far: the batch operator
        over the exactly labelled main output (``refire_panes_stream`` reads no history)."""
        return W.refire_panes(self.main_rows(spark).drop("batch_id"), key, value, order=self.order, row_id=row_id)


class WindowProcessor(StatefulProcessor):
    """Rows of one (key, window) until it closes; ``fn(key, start, end, rows)`` yields tuples then."""

    def __init__(self, fn: Callable, names: Sequence[str], cols: Sequence[str], schema: str, ts: str, order: str,
                 size_ms: int, slices: int = SLICES):
        self.fn, self.names, self.cols, self.schema = fn, list(names), list(cols), schema
        self.ts, self.order, self.size_ms, self.slices = ts, order, size_ms, max(1, min(slices, size_ms))
        self.width = -(-size_ms // self.slices)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = [handle.getListState(f"slice{k}", self.schema) for k in range(self.slices)]
        self.filled = handle.getValueState("filled", "slices long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, list[tuple]] = {}
        for r in rows:
            new.setdefault((r[self.ts] - key[1]) // self.width, []).append(tuple(r[c] for c in self.cols))
        before = self.filled.get()[0] if self.filled.exists() else 0
        for k, items in new.items():
            self.rows[k].appendList(items)
        self.filled.update((before | sum(1 << k for k in new),))
        if not before:
            self.handle.registerTimer(key[1] + self.size_ms - 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        filled = self.filled.get()[0]
        at = self.cols.index(self.ts), self.cols.index(self.order)

        def merged() -> Iterator[Row]:
            make = Row(*self.cols)
            for k in range(self.slices):
                if filled >> k & 1:
                    for item in sorted((tuple(x) for x in self.rows[k].get()), key=lambda x: (x[at[0]], x[at[1]])):
                        yield make(*item)

        for out in self.fn(key[0], key[1], key[1] + self.size_ms, merged()):
            yield Row(**dict(zip(self.names, out)))
        for k in range(self.slices):
            if filled >> k & 1:
                self.rows[k].clear()
        self.filled.clear()

    def close(self) -> None:
        pass


def apply_window_stream(stamped: DataFrame, key: str, size_ms: int, fn: Callable[..., Iterator[tuple]], schema: str,
                        cols: Sequence[str], ts: str = "time_stamp", order: str = "seq", slices: int = SLICES) -> DataFrame:
    """``fn(key, window_start, window_end, rows)`` once per window that closes.

    ``rows`` iterates over ``cols`` (and the two order columns) sorted by (event time, arrival);
    the function yields tuples of ``schema``.  Too-late rows are dropped by their stamp (L1), rows
    without an event time belong to no window.
    """
    cols = list(dict.fromkeys([*cols, ts, order]))
    labelled = W.label_lateness(stamped, size_ms, 0, ts=ts).where(F.col("window_start").isNotNull())
    kept = W.emitted_rows(labelled).select(key, "window_start", *cols)
    types = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in cols)
    out = StructType.fromDDL(schema)
    processor = WindowProcessor(fn, out.names, cols, types, ts, order, size_ms, slices)
    return transform_with_state(kept, [key, "window_start"], processor, out, "EventTime")


def _positions(row_id: str, value: str, ts: str) -> Callable[..., Iterator[tuple]]:
    def fn(key, start, end, rows):
        for pos, r in enumerate(rows, 1):
            yield key, start, end, pos, r[row_id], r[ts], r[value]

    return fn


def sorted_rows_stream(stamped: DataFrame, key: str, size_ms: int, value: str = "temperature", ts: str = "time_stamp",
                       order: str = "seq", row_id: str = "event_id", slices: int = SLICES) -> DataFrame:
    """Rows of each closed window in event-time order with their position (O1, A1)."""
    of = {c: stamped.schema[c].dataType.simpleString() for c in (key, row_id, ts, value)}
    schema = (
        f"{key} {of[key]}, window_start long, window_end long, pos long, "
        f"{row_id} {of[row_id]}, {ts} {of[ts]}, {value} {of[value]}"
    )
    return apply_window_stream(stamped, key, size_ms, _positions(row_id, value, ts), schema, [row_id, value], ts, order, slices)


class PaneProcessor(StatefulProcessor):
    """One window's running aggregate; pane 0 when it closes, one pane per allowed-late row."""

    STATE = (
        "n long, total double, low double, high double, late long, late_total double, late_low double, "
        "late_high double, fired boolean"
    )

    def __init__(self, key: str, size_ms: int, lateness_ms: int, value: str, order: str, row_id: str):
        self.key, self.size_ms, self.lateness_ms = key, size_ms, lateness_ms
        self.value, self.order, self.row_id = value, order, row_id

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pane", self.STATE)

    @staticmethod
    def _add(total, low, high, v):
        if v is None:
            return total, low, high
        return (total or 0.0) + v, v if low is None else min(low, v), v if high is None else max(high, v)

    def _pane(self, key, pane: int, fired_by, n: int, total, low, high) -> Row:
        named = {self.key: key[0], "window_start": key[1], "window_end": key[1] + self.size_ms}
        return Row(**named, pane=pane, fired_by=fired_by, n_rows=n, sum_value=total, min_value=low, max_value=high)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.state.exists()
        n, total, low, high, late, l_total, l_low, l_high, fired = tuple(self.state.get()) if known else (
            0, None, None, None, 0, None, None, None, False)
        waiting = []
        for r in rows:
            if r["label"] == W.ON_TIME:  # any order: all on-time rows arrived before the first late one
                n += 1
                total, low, high = self._add(total, low, high, r[self.value])
            else:
                waiting.append(r)
        if waiting and not fired and n:
            yield self._pane(key, 0, None, n, total, low, high)
            fired = True
        pick = lambda f, *x: f((v for v in x if v is not None), default=None)
        for r in sorted(waiting, key=lambda r: r[self.order]):
            late += 1
            l_total, l_low, l_high = self._add(l_total, l_low, l_high, r[self.value])
            whole = (total or 0.0) + (l_total or 0.0)
            yield self._pane(key, late, r[self.row_id], n + late, whole, pick(min, low, l_low), pick(max, high, l_high))
        self.state.update((n, total, low, high, late, l_total, l_low, l_high, fired))
        if not known:
            closes = key[1] + self.size_ms - 1
            for at in {closes, closes + self.lateness_ms}:
                self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state = tuple(self.state.get())
        if not state[-1] and state[0]:
            yield self._pane(key, 0, None, *state[:4])
            self.state.update((*state[:-1], True))
        if expiredTimerInfo.getExpiryTimeInMs() >= key[1] + self.size_ms - 1 + self.lateness_ms:
            self.state.clear()

    def close(self) -> None:
        pass


def refire_panes_stream(stamped: DataFrame, key: str, value: str, size_ms: int, lateness_ms: int,
                        ts: str = "time_stamp", order: str = "seq", row_id: str = "event_id") -> DataFrame:
    """``operators.windows.refire_panes`` on a stream; state per window, no history (L2)."""
    labelled = W.label_lateness(stamped, size_ms, lateness_ms, ts=ts).where(F.col("window_start").isNotNull())
    kept = W.emitted_rows(labelled).select(key, "window_start", "label", order, row_id, F.col(value).cast("double").alias(value))
    of = {c: kept.schema[c].dataType.simpleString() for c in (key, row_id)}
    schema = (
        f"{key} {of[key]}, window_start long, window_end long, pane long, fired_by {of[row_id]}, n_rows long, "
        "sum_value double, min_value double, max_value double"
    )
    processor = PaneProcessor(key, size_ms, lateness_ms, value, order, row_id)
    return transform_with_state(kept, [key, "window_start"], processor, schema, "EventTime")


def late_rows_stream(stamped: DataFrame, size_ms: int, lateness_ms: int, ts: str = "time_stamp") -> DataFrame:
    """The side output of a stamped stream (L3): rows later than the allowed lateness."""
    return W.late_side_output(W.label_lateness(stamped, size_ms, lateness_ms, ts=ts))
