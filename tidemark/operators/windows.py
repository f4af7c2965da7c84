"""Tumbling event-time windows (W1-W3, A1, O1) and lateness (L1-L4).

Batch normal form: every row carries ``wm_ms`` (``plans.watermark``).  With
window ``[start, end)`` and allowed lateness ``L``:

* ``too_late``      if ``end - 1 + L <= wm``  (dropped, or side output),
* ``allowed_late``  if not too late and ``end - 1 <= wm`` (re-fires the window),
* ``on_time``       otherwise.

Window assignment and labelling are projections (no shuffle); only
aggregations shuffle, on (key, window) with map-side partial aggregation.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.scan import OrderStats, row_number, scan

ON_TIME = "on_time"
ALLOWED_LATE = "allowed_late"
TOO_LATE = "too_late"


def assign_tumbling(df: DataFrame, size_ms: int, ts: str = "ts_ms") -> DataFrame:
    """Epoch-aligned ``[window_start, window_end)`` in epoch ms."""
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(size_ms))
    return df.withColumns({"window_start": start, "window_end": start + F.lit(size_ms)})


def label_lateness(
    df: DataFrame, size_ms: int, lateness_ms: int = 0, ts: str = "ts_ms", wm: str = "wm_ms", out: str = "label"
) -> DataFrame:
    """Window columns plus ``label`` in {on_time, allowed_late, too_late} (L1, L2)."""
    w = assign_tumbling(df, size_ms, ts)
    last = F.col("window_end") - F.lit(1)
    has_wm = F.col(wm).isNotNull()
    too_late = has_wm & (last + F.lit(lateness_ms) <= F.col(wm))
    fired = has_wm & (last <= F.col(wm))
    label = F.when(too_late, F.lit(TOO_LATE)).when(fired, F.lit(ALLOWED_LATE)).otherwise(F.lit(ON_TIME))
    return w.withColumn(out, label)


def emitted_rows(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Rows a window function re-emits (A1): everything not dropped as too late."""
    return labelled.where(F.col(label) != F.lit(TOO_LATE))


def late_side_output(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Rows routed to the late side output (L3)."""
    return labelled.where(F.col(label) == F.lit(TOO_LATE))


def window_aggregate(
    df: DataFrame, keys: Sequence[str], value: str, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Built-in aggregates per (key, window); partial aggregation before the shuffle."""
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(value).alias("sum_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.round(F.avg(value), 6).alias("avg_value"),
    ]
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    return df.groupBy(*keys, "window_start", "window_end").agg(*aggs)


def refire_panes(
    labelled: DataFrame, key: str, value: str, order: str = "seq", label: str = "label", row_id: str = "event_id",
    stats: OrderStats | None = None,
) -> DataFrame:
    """One row per firing of each (key, window) (L2).

    Pane 0 holds the on-time rows (absent when there are none); pane i adds the
    first i allowed-late rows in arrival order and is fired by the i-th one.
    Each pane's content is summarised by count/sum/min/max - the cumulative
    frame is computed with the skew-safe scan, so no pane is ever materialised
    as a list.
    """
    wkeys = [key, "window_start", "window_end"]
    on_time = labelled.where(F.col(label) == ON_TIME).groupBy(*wkeys).agg(
        F.count(F.lit(1)).alias("base_n"),
        F.sum(value).alias("base_sum"),
        F.min(value).alias("base_min"),
        F.max(value).alias("base_max"),
    )
    late = labelled.where(F.col(label) == ALLOWED_LATE)
    late = scan(
        late,
        [order],
        {
            "pane": ("sum", F.lit(1)),
            "late_sum": ("sum", F.col(value)),
            "late_min": ("min", F.col(value)),
            "late_max": ("max", F.col(value)),
        },
        partition_by=wkeys,
        inclusive=True,
        stats=stats,
    )
    fired = late.join(on_time, wkeys, "left").select(
        *wkeys,
        F.col("pane").cast("bigint").alias("pane"),
        F.col(row_id).alias("fired_by"),
        (F.coalesce("base_n", F.lit(0)) + F.col("pane")).cast("bigint").alias("n_rows"),
        (F.coalesce("base_sum", F.lit(0.0)) + F.col("late_sum")).alias("sum_value"),
        F.least("base_min", "late_min").alias("min_value"),
        F.greatest("base_max", "late_max").alias("max_value"),
    )
    first = on_time.select(
        *wkeys,
        F.lit(0).cast("bigint").alias("pane"),
        F.lit(None).cast(labelled.schema[row_id].dataType).alias("fired_by"),
        F.col("base_n").cast("bigint").alias("n_rows"),
        F.col("base_sum").alias("sum_value"),
        F.col("base_min").alias("min_value"),
        F.col("base_max").alias("max_value"),
    )
    return first.unionByName(fired)


def sorted_window_rows(
    df: DataFrame, key: str, ts: str = "ts_ms", order: str = "seq", out: str = "pos",
    stats: OrderStats | None = None,
) -> DataFrame:
    """Rows of each (key, window) with their position by event time.

    Java's stable list sort keeps arrival order for equal times, hence the
    ``(ts, seq)`` order.  The position is a skew-safe running count, so a hot
    window is split across tasks instead of being collected.
    """
    return row_number(df, out, [ts, order], partition_by=[key, "window_start"], stats=stats)


def apply_window_function(
    df: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame | dict[str, np.ndarray]], pd.DataFrame | dict | list],
    schema: str,
    per_window: bool = True,
    arrays: bool = False,
) -> DataFrame:
    """Arbitrary user window function (W2, W3): ``fn`` sees whole windows as pandas.

    This is the slow path for logic that built-in aggregates cannot express.
    Rows are hash-partitioned by (key, window) and sorted inside each partition
    by Spark; ``mapInPandas`` then cuts the Arrow batches at window boundaries,
    carrying only the trailing, still incomplete window into the next batch.
    With ``per_window`` the function is called once per window (the
    reference's ``WindowFunction.apply`` contract); otherwise it receives
    batches of complete windows and may vectorise across them.  A per-window
    function may return a DataFrame, one record (a dict) or a list of records;
    records are assembled into one frame per Arrow batch.  A pandas frame per
    window costs more than most functions where windows hold few rows: with
    ``arrays`` a per-window function gets its window as a dict of numpy arrays,
    one per column, instead.
    """
    gkeys = [key, "window_start"]
    # An explicit partition count: AQE must not fold Python work into one task.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Windows are told apart by text: NULL keys equal each other, long keys stay exact.
    name = F.concat(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n")), F.lit("|"), F.col("window_start"))
    part = df.repartition(n, *gkeys).sortWithinPartitions(*gkeys).withColumn("__window", name)
    integral = df.schema[key].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if integral:
        part = part.withColumn(key, F.col(key).cast("string"))
    empty = pd.DataFrame(columns=StructType.fromDDL(schema).names)

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        """The frame that the user's function sees."""
        if integral:
            values = pdf[key]
            exact = pd.array([None if v is None else int(v) for v in values], dtype="Int64")
            pdf = pdf.assign(**{key: exact if values.isna().any() else exact.to_numpy("int64")})
        return pdf.drop(columns="__window")

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        window = pdf["__window"].to_numpy()
        pdf = whole(pdf)
        if not per_window:
            return fn(pdf)
        # rows arrive sorted by (key, window): cut at the change points
        cuts = np.flatnonzero(window[1:] != window[:-1]) + 1
        bounds = np.concatenate(([0], cuts, [len(pdf)]))
        frames, records = [], []
        whole_cols = {c: pdf[c].to_numpy() for c in pdf.columns} if arrays else {}
        for a, b in itertools.pairwise(bounds.tolist()):
            res = fn({c: v[a:b] for c, v in whole_cols.items()} if arrays else pdf.iloc[a:b])
            if isinstance(res, pd.DataFrame):
                frames.append(res)
            elif isinstance(res, dict):
                records.append(res)
            elif res is not None:
                records.extend(res)
        if records:
            frames.append(pd.DataFrame.from_records(records))
        frames = [f for f in frames if len(f)]
        if not frames:
            return empty
        return pd.concat(frames, ignore_index=True) if len(frames) != 1 else frames[0]

    def run(batches):
        carry: list[pd.DataFrame] = []  # pieces of the trailing window, joined once it ends
        for b in batches:
            if not len(b):
                continue
            if carry and b["__window"].iloc[0] != carry[-1]["__window"].iloc[-1]:
                yield call(pd.concat(carry, ignore_index=True))
                carry = []
            tail = (b["__window"] == b["__window"].iloc[-1]).to_numpy()
            if tail.all():
                carry.append(b)
                continue
            yield call(pd.concat([*carry, b[~tail]], ignore_index=True))
            carry = [b[tail]]
        if carry:
            yield call(pd.concat(carry, ignore_index=True))

    return part.mapInPandas(run, schema)


def apply_window_rows(
    df: DataFrame,
    key: str,
    fn: Callable[[object, int, int, Iterable[Row]], Iterable[tuple]],
    schema: str,
    cols: Sequence[str],
    ts: str = "time_stamp",
    order: str = "seq",
    batch_rows: int = 10_000,
) -> DataFrame:
    """User window function over an iterator of rows (W2, W3); same contract as on a stream.

    ``fn(key, window_start, window_end, rows)`` is called once per (key, window) and yields tuples
    of ``schema``; ``rows`` holds ``cols`` (and the two order columns) by (event time, arrival), to
    be read once.  Rows come from Arrow batches that Spark has shuffled by (key, window) and
    sorted, so a task holds one batch, however large a window is; the number of tasks is left to
    adaptive execution.  NULL keys are one key; a window whose function yields nothing is absent.
    """
    cols = list(dict.fromkeys([*cols, ts, order]))
    # windows are told apart by text: NULL is a key, and long keys stay exact
    name = F.concat(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n")), F.lit("|"), F.col("window_start"))
    heads = [name.alias("__window"), F.col(key).alias("__key"), F.col("window_start").alias("__start"), F.col("window_end").alias("__end")]
    part = df.select(*heads, *cols).repartition("__window").sortWithinPartitions("__window", ts, order)
    out = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted, make, found = to_arrow_schema(out), Row(*cols), []
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for _, window in itertools.groupby(rows, key=lambda r: r[0]):
            first = next(window)
            whole = itertools.chain([first], window)
            for values in fn(*first[1:4], (make(*r[4:]) for r in whole)):
                found.append(dict(zip(wanted.names, values)))
                if len(found) >= batch_rows:
                    yield pa.RecordBatch.from_pylist(found, wanted)
                    found = []
        yield pa.RecordBatch.from_pylist(found, wanted)

    return part.mapInArrow(run, out)
