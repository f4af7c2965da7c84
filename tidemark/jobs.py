"""End-to-end jobs of the reference, composed from the operators.

Each job takes already-typed rows (with an arrival order ``seq``), so the same
code runs on the driver's tables, on the reference's sample files and in tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import sequence as C
from tidemark.operators import windows as W
from tidemark.operators import zipjoin as Z
from tidemark.plans.lineage import cut
from tidemark.plans.scan import OrderStats, keyed_order_stats, order_stats_multi
from tidemark.plans.watermark import WatermarkSpec, stamp_watermark


def step_pattern(steps: Sequence[str], content: str = "content") -> C.SequencePattern:
    """step1, then step2, ... by content prefix (relaxed contiguity)."""
    p = C.SequencePattern.begin(steps[0], F.col(content).startswith(steps[0]))
    for s in steps[1:]:
        p = p.followed_by(s, F.col(content).startswith(s))
    return p


class BaseStats:
    """Order bounds of a job's base rows, from one aggregate job.

    ``glob[c]`` bounds global scans over column ``c``; ``keyed[c]`` bounds
    scans partitioned by (a superset of) ``key``: its row bound is the largest
    key's row count, so keyed scans skip bucketing unless some key is hot.
    """

    def __init__(self, df: DataFrame, cols=("seq", "time_stamp"), key=("workpiece",), keyed: bool = True):
        if keyed:
            self.glob, self.keyed = keyed_order_stats(df, list(cols), list(key))
        else:  # global scans only: a plain aggregate, no shuffle
            self.glob, self.keyed = order_stats_multi(df, list(cols)), None

    def __getitem__(self, col: str) -> OrderStats:
        return self.glob[col]


def base_stats(df: DataFrame, cols=("seq", "time_stamp"), key=("workpiece",), keyed: bool = True) -> BaseStats:
    return BaseStats(df, cols, key, keyed)


def window_job(
    readings: DataFrame, spec: WatermarkSpec, size_ms: int, lateness_ms: int = 0, ts: str = "time_stamp",
    stats: OrderStats | None = None,
) -> DataFrame:
    """Watermark stamp -> tumbling window -> lateness label, per reading."""
    return W.label_lateness(stamp_watermark(readings, spec, ts=ts, stats=stats), size_ms, lateness_ms, ts=ts)


def track_process(
    log: DataFrame,
    spec: WatermarkSpec,
    steps: Sequence[str],
    idle_ttl_ms: int | None,
    key: str = "workpiece",
    stream: str = "station",
    streams: Sequence[object] = (1, 2),
    keyed_match: bool = False,
    stats: BaseStats | None = None,
) -> DataFrame:
    """Union of stations -> keyed FIFO zip (idle TTL) -> pattern -> select.

    The zipped rows are the original events (with their content) stamped with
    the trigger's event time and watermark; the pattern runs over them in
    (trigger time, trigger arrival, step) order, non-keyed like the reference
    unless ``keyed_match``.
    """
    st = stats or base_stats(log, key=[key])
    seq_st, key_st = st["seq"], st.keyed["seq"]
    stamped = stamp_watermark(
        log, spec, ts="time_stamp", stream=stream, streams=streams, stats=seq_st, clock="clock_ms"
    )
    group: list[str] = []
    if idle_ttl_ms is not None:
        stamped = cut(Z.gap_sessions(stamped, key, idle_ttl_ms, stats=key_st))
        group = ["session"]
    routed = Z.route_steps(stamped, Z.contains_routes(steps))
    tuples = cut(Z.zip_join(routed, key, steps, group=group, carry=["wm_ms"], stats=key_st, item_cols=["content"]))
    rows = Z.emit_rows(tuples, key, steps, group=group, carry=["trigger_wm_ms"], item_cols=["content"])
    timed = rows.withColumns({"row_ts": F.col("time_stamp"), "time_stamp": F.col("trigger_ts")})
    kept = C.drop_late(timed, ts="time_stamp", wm="trigger_wm_ms")
    # The zipped rows are read back from the cut, so their own bounds cost one
    # cheap scan and are tighter than the base table's.
    if keyed_match:
        match_st = keyed_order_stats(kept, ["trigger_ts"], [key])[1]["trigger_ts"]
    else:
        match_st = order_stats_multi(kept, ["trigger_ts"])["trigger_ts"]
    m = C.match_sequence(
        kept, step_pattern(steps, "content"), order=["trigger_ts", "trigger_seq", "pos"],
        partition_by=[key] if keyed_match else None, payload=["row_ts", key], stats=match_st,
    )
    return m.select(
        F.col(f"{steps[0]}_{key}").alias(key),
        *[x for s in steps for x in (F.lit(s).alias(f"{s}_name"), F.col(f"{s}_row_ts").alias(f"{s}_ts"))],
        F.lit(len(steps)).cast("bigint").alias("n_events"),
    )
