"""Named queries over the driver's tables, each with an equivalent DuckDB SQL.

Every query reads the given parquet tables (mostly ``events`` through the
adapters in ``sources.events``) and runs over all of their rows.  Parameters
are fixed here, once, and shared by the Spark code and the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parse import FAILFAST, parse_log_lines, parse_sensor_lines
from tidemark.operators import windows as W
from tidemark.plans.watermark import (
    WatermarkSpec,
    bounded_out_of_orderness,
    monotonous,
    periodic_generator,
    stamp_watermark,
)
from tidemark.jobs import base_stats
from tidemark.sources import events as E

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

HOUR_MS = 3_600_000
# Fixed parameters of the window jobs on the events table (hours instead of the
# reference's seconds, because the table spans 30 days).
SIZE_MS = 6 * HOUR_MS
DELAY_MS = 3 * HOUR_MS
LATENESS_MS = 1 * HOUR_MS
SORTED_SIZE_MS = 6 * HOUR_MS
SORTED_DELAY_MS = 6 * HOUR_MS
# The custom generator emits max - 3000 ms; the monotonous one max - 1.
CUSTOM_DELAY_MS = 3000


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return register


# ---------------------------------------------------------------- SQL pieces
SEQ_SQL = "((event_id + (event_id * 7919) % 97) * 128 + (96 - (event_id * 7919) % 97))"
MS_SQL = "(epoch_us(ts) // 1000)"
SENSOR_CTE = (
    "sensor AS (SELECT event_id, CAST(user_id AS VARCHAR) AS id, "
    f"{MS_SQL} AS time_stamp, value AS temperature, {SEQ_SQL} AS seq FROM events)"
)


def _stamped_cte(lag_ms: int, src: str = "sensor", name: str = "stamped") -> str:
    return (
        f"{name} AS (SELECT *, max(time_stamp) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
        f"AND 1 PRECEDING) - {lag_ms} AS wm_ms FROM {src})"
    )


def _labelled_cte(size_ms: int, lateness_ms: int, src: str = "stamped", name: str = "labelled") -> str:
    return (
        f"{name} AS (SELECT *, time_stamp - time_stamp % {size_ms} AS window_start, "
        f"time_stamp - time_stamp % {size_ms} + {size_ms} AS window_end, "
        f"CASE WHEN wm_ms IS NOT NULL AND time_stamp - time_stamp % {size_ms} + {size_ms} - 1 + {lateness_ms} <= wm_ms "
        f"THEN 'too_late' WHEN wm_ms IS NOT NULL AND time_stamp - time_stamp % {size_ms} + {size_ms} - 1 <= wm_ms "
        f"THEN 'allowed_late' ELSE 'on_time' END AS label FROM {src})"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- helpers
def _sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.sensor_readings(spark, sf_dir)


def _stats(spark: SparkSession, sf_dir: str, keyed: bool = True):
    """Bounds of ``seq`` and ``time_stamp`` of the events adapters: one small job per query.

    ``keyed`` adds the largest per-user row count (one more shuffle of a tiny
    partial aggregate); queries without keyed scans skip it.
    """
    return base_stats(_sensor(spark, sf_dir), key=["id"], keyed=keyed)


def _labelled(spark: SparkSession, sf_dir: str, spec: WatermarkSpec, size_ms: int, lateness_ms: int,
              st=None) -> DataFrame:
    st = st or _stats(spark, sf_dir, keyed=False)
    stamped = stamp_watermark(_sensor(spark, sf_dir), spec, ts="time_stamp", stats=st["seq"])
    return W.label_lateness(stamped, size_ms, lateness_ms, ts="time_stamp")


ROW_COLS = ["id", "window_start", "window_end", "event_id", "time_stamp", "temperature"]


# ---------------------------------------------------------------- M0: parse + tumbling window
@query(
    "parse_sensor_lines",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS id, " + MS_SQL + " AS time_stamp, value AS temperature FROM events",
)
def parse_sensor_lines_q(spark, sf_dir):
    rows, _ = parse_sensor_lines(E.sensor_lines(spark, sf_dir), mode=FAILFAST, keep=["event_id"])
    return rows


@query(
    "parse_log_lines",
    f"""SELECT event_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'workStation_2' ELSE 'workStation_1' END AS id,
  CAST(user_id AS VARCHAR) AS workpiece, {MS_SQL} AS time_stamp,
  CASE event_type WHEN 'view' THEN 'step1' WHEN 'click' THEN 'step2' WHEN 'signup' THEN 'step3'
    WHEN 'purchase' THEN 'step4' ELSE 'error' END AS content
FROM events""",
)
def parse_log_lines_q(spark, sf_dir):
    rows, _ = parse_log_lines(E.log_lines(spark, sf_dir), mode=FAILFAST, keep=["event_id"])
    return rows


_AGG_SQL = (
    "count(*) AS n_rows, round(sum(temperature), 6) AS sum_value, min(temperature) AS min_value, "
    "max(temperature) AS max_value, round(avg(temperature), 6) AS avg_value"
)


def _agg(df: DataFrame) -> DataFrame:
    out = W.window_aggregate(df, ["id"], "temperature")
    return out.withColumn("sum_value", F.round("sum_value", 6))


@query(
    "win_tumbling_counts",
    _with(SENSOR_CTE)
    + f"""SELECT id, time_stamp - time_stamp % {SIZE_MS} AS window_start,
  time_stamp - time_stamp % {SIZE_MS} + {SIZE_MS} AS window_end, {_AGG_SQL}
FROM sensor GROUP BY 1, 2, 3""",
)
def win_tumbling_counts(spark, sf_dir):
    return _agg(W.assign_tumbling(_sensor(spark, sf_dir), SIZE_MS, ts="time_stamp"))


# ---------------------------------------------------------------- M1: watermark, bounded windows, drop
@query(
    "wm_prefix_max",
    _with(SENSOR_CTE, _stamped_cte(DELAY_MS + 1)) + "SELECT event_id, time_stamp, wm_ms FROM stamped",
)
def wm_prefix_max(spark, sf_dir):
    s = stamp_watermark(_sensor(spark, sf_dir), bounded_out_of_orderness(DELAY_MS), ts="time_stamp")
    return s.select("event_id", "time_stamp", "wm_ms")


def _rows_oracle(lag_ms: int, size_ms: int) -> str:
    return (
        _with(SENSOR_CTE, _stamped_cte(lag_ms), _labelled_cte(size_ms, 0))
        + "SELECT id, window_start, window_end, event_id, time_stamp, temperature FROM labelled "
        "WHERE label <> 'too_late'"
    )


def _rows(spark, sf_dir, spec: WatermarkSpec, size_ms: int) -> DataFrame:
    return W.emitted_rows(_labelled(spark, sf_dir, spec, size_ms, 0)).select(*ROW_COLS)


@query("win_bounded_rows", _rows_oracle(DELAY_MS + 1, SIZE_MS))
def win_bounded_rows(spark, sf_dir):
    return _rows(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS)


@query("win_monotonous_rows", _rows_oracle(1, SIZE_MS))
def win_monotonous_rows(spark, sf_dir):
    return _rows(spark, sf_dir, monotonous(), SIZE_MS)


@query("win_custom_rows", _rows_oracle(CUSTOM_DELAY_MS, SIZE_MS))
def win_custom_rows(spark, sf_dir):
    return _rows(spark, sf_dir, periodic_generator(CUSTOM_DELAY_MS), SIZE_MS)


@query(
    "win_bounded_agg",
    _with(SENSOR_CTE, _stamped_cte(DELAY_MS + 1), _labelled_cte(SIZE_MS, 0))
    + f"SELECT id, window_start, window_end, {_AGG_SQL} FROM labelled WHERE label <> 'too_late' GROUP BY 1, 2, 3",
)
def win_bounded_agg(spark, sf_dir):
    return _agg(W.emitted_rows(_labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, 0)))


@query(
    "late_dropped",
    _with(SENSOR_CTE, _stamped_cte(DELAY_MS + 1), _labelled_cte(SIZE_MS, 0))
    + "SELECT id, event_id, time_stamp, window_start, wm_ms FROM labelled WHERE label = 'too_late'",
)
def late_dropped(spark, sf_dir):
    lab = _labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, 0)
    return W.late_side_output(lab).select("id", "event_id", "time_stamp", "window_start", "wm_ms")


# ---------------------------------------------------------------- M2: lateness, panes, sorting, UDF
_LATE_CTES = (SENSOR_CTE, _stamped_cte(DELAY_MS + 1), _labelled_cte(SIZE_MS, LATENESS_MS))


def _late_labelled(spark, sf_dir) -> DataFrame:
    return _labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, LATENESS_MS)


@query(
    "late_labels",
    _with(*_LATE_CTES) + "SELECT event_id, id, window_start, wm_ms, label FROM labelled",
)
def late_labels(spark, sf_dir):
    return _late_labelled(spark, sf_dir).select("event_id", "id", "window_start", "wm_ms", "label")


@query(
    "late_side_output",
    _with(*_LATE_CTES)
    + "SELECT id, window_start, event_id, time_stamp, temperature, wm_ms FROM labelled WHERE label = 'too_late'",
)
def late_side_output_q(spark, sf_dir):
    return W.late_side_output(_late_labelled(spark, sf_dir)).select(
        "id", "window_start", "event_id", "time_stamp", "temperature", "wm_ms"
    )


@query(
    "win_refire_panes",
    _with(
        *_LATE_CTES,
        """base AS (SELECT id, window_start, window_end, count(*) AS base_n, sum(temperature) AS base_sum,
  min(temperature) AS base_min, max(temperature) AS base_max FROM labelled WHERE label = 'on_time' GROUP BY 1, 2, 3)""",
        """late AS (SELECT id, window_start, window_end, event_id,
  row_number() OVER w AS pane, sum(temperature) OVER w AS late_sum,
  min(temperature) OVER w AS late_min, max(temperature) OVER w AS late_max
  FROM labelled WHERE label = 'allowed_late'
  WINDOW w AS (PARTITION BY id, window_start ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    )
    + """SELECT id, window_start, window_end, 0 AS pane, NULL::BIGINT AS fired_by, base_n AS n_rows,
  round(base_sum, 6) AS sum_value, base_min AS min_value, base_max AS max_value FROM base
UNION ALL
SELECT l.id, l.window_start, l.window_end, l.pane, l.event_id AS fired_by, coalesce(b.base_n, 0) + l.pane AS n_rows,
  round(coalesce(b.base_sum, 0) + l.late_sum, 6) AS sum_value,
  CASE WHEN b.base_min IS NULL OR l.late_min < b.base_min THEN l.late_min ELSE b.base_min END AS min_value,
  CASE WHEN b.base_max IS NULL OR l.late_max > b.base_max THEN l.late_max ELSE b.base_max END AS max_value
FROM late l LEFT JOIN base b USING (id, window_start, window_end)""",
)
def win_refire_panes(spark, sf_dir):
    st = _stats(spark, sf_dir)
    lab = _labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, LATENESS_MS, st)
    panes = W.refire_panes(lab, "id", "temperature", stats=st.keyed["seq"])
    return panes.withColumn("sum_value", F.round("sum_value", 6))


@query(
    "win_sorted_rows",
    _with(SENSOR_CTE, _stamped_cte(SORTED_DELAY_MS + 1), _labelled_cte(SORTED_SIZE_MS, 0))
    + """SELECT id, window_start, window_end,
  row_number() OVER (PARTITION BY id, window_start ORDER BY time_stamp, seq) AS pos,
  event_id, time_stamp, temperature
FROM labelled WHERE label <> 'too_late'""",
)
def win_sorted_rows(spark, sf_dir):
    st = _stats(spark, sf_dir)
    rows = W.emitted_rows(
        _labelled(spark, sf_dir, bounded_out_of_orderness(SORTED_DELAY_MS), SORTED_SIZE_MS, 0, st)
    )
    out = W.sorted_window_rows(rows, "id", ts="time_stamp", stats=st.keyed["time_stamp"])
    return out.select("id", "window_start", "window_end", F.col("pos").cast("bigint").alias("pos"),
                      "event_id", "time_stamp", "temperature")


def _spread_fn(window: dict[str, np.ndarray]) -> dict:
    """Example user window function: size, temperature spread, earliest row."""
    temp = window["temperature"]
    first = np.lexsort((window["seq"], window["time_stamp"]))[0]
    return {
        "id": window["id"][0],
        "window_start": int(window["window_start"][0]),
        "window_end": int(window["window_end"][0]),
        "n_rows": len(temp),
        "spread": round(float(temp.max() - temp.min()), 6),
        "first_event": int(window["event_id"][first]),
    }


@query(
    "win_apply_udf",
    _with(SENSOR_CTE, _stamped_cte(DELAY_MS + 1), _labelled_cte(SIZE_MS, 0))
    + """SELECT id, window_start, window_end, count(*) AS n_rows,
  round(max(temperature) - min(temperature), 6) AS spread,
  first(event_id ORDER BY time_stamp, seq) AS first_event
FROM labelled WHERE label <> 'too_late' GROUP BY 1, 2, 3""",
)
def win_apply_udf(spark, sf_dir):
    rows = W.emitted_rows(_labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, 0))
    return W.apply_window_function(
        rows.select("id", "window_start", "window_end", "event_id", "time_stamp", "temperature", "seq"),
        "id",
        _spread_fn,
        "id string, window_start bigint, window_end bigint, n_rows bigint, spread double, first_event bigint",
        arrays=True,
    )


def _spread_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """The same user function, vectorised over a batch of complete windows."""
    keys = ["id", "window_start", "window_end"]
    ordered = pdf.sort_values(keys + ["time_stamp", "seq"], kind="stable")
    g = ordered.groupby(keys, sort=False)
    out = g["temperature"].agg(["size", "min", "max"]).reset_index()
    out["first_event"] = g["event_id"].first().to_numpy()
    out["spread"] = (out["max"] - out["min"]).round(6)
    return out.rename(columns={"size": "n_rows"})[keys + ["n_rows", "spread", "first_event"]]


@query("win_apply_udf_batched", ORACLE["win_apply_udf"])
def win_apply_udf_batched(spark, sf_dir):
    rows = W.emitted_rows(_labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, 0))
    return W.apply_window_function(
        rows.select("id", "window_start", "window_end", "event_id", "time_stamp", "temperature", "seq"),
        "id",
        _spread_batch,
        "id string, window_start bigint, window_end bigint, n_rows bigint, spread double, first_event bigint",
        per_window=False,
    )


def _spread_rows(key, start, end, rows):
    """The same user function over an iterator of rows in event-time order."""
    n, low, high, first = 0, None, None, None
    for r in rows:
        first = r["event_id"] if n == 0 else first
        n, t = n + 1, r["temperature"]
        low, high = (t, t) if low is None else (min(low, t), max(high, t))
    yield key, start, end, n, round(high - low, 6), first


SPREAD = "id string, window_start bigint, window_end bigint, n_rows bigint, spread double, first_event bigint"


@query("win_apply_rows", ORACLE["win_apply_udf"])
def win_apply_rows(spark, sf_dir):
    rows = W.emitted_rows(_labelled(spark, sf_dir, bounded_out_of_orderness(DELAY_MS), SIZE_MS, 0))
    return W.apply_window_rows(rows, "id", _spread_rows, SPREAD, ["event_id", "temperature"])


# ---------------------------------------------------------------- M3: routing, union, zip join, TTL
from tidemark.operators import zipjoin as Z  # noqa: E402
from tidemark.plans.lineage import cut  # noqa: E402
from tidemark.plans.watermark import running_max  # noqa: E402

LOG_DELAY_MS = 3 * HOUR_MS
IDLE_TTL_MS = 24 * HOUR_MS
WRITE_TTL_MS = 24 * HOUR_MS
STEPS = E.STEPS

LOG_CTE = f"""log AS (SELECT event_id,
  CASE WHEN event_type IN ('click', 'purchase') THEN 2 ELSE 1 END AS station,
  CAST(user_id AS VARCHAR) AS workpiece, {MS_SQL} AS time_stamp,
  CASE event_type WHEN 'view' THEN 'step1' WHEN 'click' THEN 'step2' WHEN 'signup' THEN 'step3'
    WHEN 'purchase' THEN 'step4' ELSE 'error' END AS content, {SEQ_SQL} AS seq FROM events)"""
STEPS_CTE = "steps(step) AS (VALUES ('step1'), ('step2'), ('step3'), ('step4'))"
ROUTED_CTE = "routed AS (SELECT log.*, steps.step FROM log JOIN steps ON contains(log.content, steps.step))"
CLOCK_CTE = (
    "clocked AS (SELECT *, max(time_stamp) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    "AS clock_ms FROM log)"
)


def _zip_sql(src: str, parts: str) -> str:
    """Oracle of the FIFO zip over ``src`` (routed rows) per ``parts``."""
    cols = ",\n  ".join(
        f"max(CASE WHEN step = '{s}' THEN time_stamp END) AS {s}_ts, max(CASE WHEN step = '{s}' THEN event_id END) AS {s}_event, "
        f"max(CASE WHEN step = '{s}' THEN seq END) AS {s}_seq"
        for s in STEPS
    )
    seqs = ", ".join(f"{s}_seq" for s in STEPS)
    pick = lambda f: "CASE " + " ".join(f"WHEN {s}_seq = trigger_seq THEN {s}_{f}" for s in STEPS) + " END"
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY {parts}, step ORDER BY seq) AS n_tuple FROM {src}),
tuples AS (SELECT {parts}, n_tuple, count(DISTINCT step) AS n_steps,
  {cols}
  FROM numbered GROUP BY {parts}, n_tuple),
zipped AS (SELECT *, greatest({seqs}) AS trigger_seq FROM tuples WHERE n_steps = {len(STEPS)}),
final AS (SELECT {parts}, n_tuple, {", ".join(f"{s}_ts" for s in STEPS)}, {", ".join(f"{s}_event" for s in STEPS)},
  trigger_seq, {pick("ts")} AS trigger_ts, {pick("event")} AS trigger_event FROM zipped)"""


def _log(spark, sf_dir) -> DataFrame:
    return E.log_events(spark, sf_dir).drop("id")


def _routed(spark, sf_dir) -> DataFrame:
    return Z.route_steps(_log(spark, sf_dir), Z.contains_routes(STEPS))


@query(
    "step_route_contains",
    _with(LOG_CTE, STEPS_CTE, ROUTED_CTE) + "SELECT event_id, workpiece, step FROM routed",
)
def step_route_contains(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "workpiece", "step")


@query(
    "union_streams",
    _with(
        LOG_CTE,
        f"""pm AS (SELECT *,
  max(CASE WHEN station = 1 THEN time_stamp END) OVER w AS pm1,
  max(CASE WHEN station = 2 THEN time_stamp END) OVER w AS pm2
  FROM log WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    )
    + f"""SELECT event_id, station, workpiece, time_stamp,
  CASE WHEN pm1 IS NULL OR pm2 IS NULL THEN NULL ELSE least(pm1, pm2) - {LOG_DELAY_MS + 1} END AS wm_ms FROM pm""",
)
def union_streams(spark, sf_dir):
    log = _log(spark, sf_dir)
    s1, s2 = log.where(F.col("station") == 1), log.where(F.col("station") == 2)
    both = s1.unionByName(s2)
    stamped = stamp_watermark(
        both, bounded_out_of_orderness(LOG_DELAY_MS), ts="time_stamp", stream="station", streams=[1, 2]
    )
    return stamped.select("event_id", "station", "workpiece", "time_stamp", "wm_ms")


ZIP_COLS = (
    ["workpiece", "n_tuple"]
    + [f"{s}_ts" for s in STEPS]
    + [f"{s}_event" for s in STEPS]
    + ["trigger_seq", "trigger_ts", "trigger_event"]
)


@query(
    "zip_join_steps",
    _with(LOG_CTE, STEPS_CTE, ROUTED_CTE, _zip_sql("routed", "workpiece")) + "SELECT * FROM final",
)
def zip_join_steps(spark, sf_dir):
    st = _stats(spark, sf_dir)
    return Z.zip_join(_routed(spark, sf_dir), "workpiece", STEPS, stats=st.keyed["seq"]).select(*ZIP_COLS)


@query(
    "zip_emit_rows",
    _with(LOG_CTE, STEPS_CTE, ROUTED_CTE, _zip_sql("routed", "workpiece"))
    + " UNION ALL ".join(
        f"SELECT workpiece, n_tuple, {i + 1} AS pos, '{s}' AS step, {s}_ts AS time_stamp, {s}_event AS event_id, "
        "trigger_seq, trigger_ts, trigger_event FROM final "
        for i, s in enumerate(STEPS)
    ),
)
def zip_emit_rows(spark, sf_dir):
    st = _stats(spark, sf_dir)
    tuples = Z.zip_join(_routed(spark, sf_dir), "workpiece", STEPS, stats=st.keyed["seq"])
    return Z.emit_rows(tuples, "workpiece", STEPS)


@query(
    "zip_pending_sizes",
    _with(
        LOG_CTE,
        """c AS (SELECT *, """
        + ", ".join(
            f"sum(CASE WHEN contains(content, '{s}') THEN 1 ELSE 0 END) OVER w AS c{i}, "
            f"CASE WHEN contains(content, '{s}') THEN 1 ELSE 0 END AS f{i}"
            for i, s in enumerate(STEPS)
        )
        + """ FROM log WINDOW w AS (PARTITION BY workpiece ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    )
    + "SELECT event_id, workpiece, content, "
    + ", ".join(
        f"c{i} - least({', '.join(f'c{j} - f{j}' for j in range(len(STEPS)))}) AS n{i + 1}" for i in range(len(STEPS))
    )
    + " FROM c",
)
def zip_pending_sizes(spark, sf_dir):
    st = _stats(spark, sf_dir)
    sizes = Z.pending_sizes(_log(spark, sf_dir), "workpiece", Z.contains_routes(STEPS), stats=st.keyed["seq"])
    return sizes.select("event_id", "workpiece", "content", *[f"n{i + 1}" for i in range(len(STEPS))])


def _sessions(spark, sf_dir, ttl_ms: int, st) -> DataFrame:
    clocked = running_max(_log(spark, sf_dir), ts="time_stamp", out="clock_ms", stats=st["seq"])
    return cut(Z.gap_sessions(clocked, "workpiece", ttl_ms, stats=st.keyed["seq"]), "sessions")


@query(
    "zip_join_idle_ttl",
    _with(
        LOG_CTE,
        CLOCK_CTE,
        f"""g AS (SELECT *, CASE WHEN lag(clock_ms) OVER (PARTITION BY workpiece ORDER BY seq) IS NULL
  OR clock_ms - lag(clock_ms) OVER (PARTITION BY workpiece ORDER BY seq) >= {IDLE_TTL_MS} THEN 1 ELSE 0 END AS new_session FROM clocked)""",
        """s AS (SELECT *, sum(new_session) OVER (PARTITION BY workpiece ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)""",
        STEPS_CTE,
        "routed AS (SELECT s.*, steps.step FROM s JOIN steps ON contains(s.content, steps.step))",
        _zip_sql("routed", "workpiece, session"),
    )
    + "SELECT * FROM final",
)
def zip_join_idle_ttl(spark, sf_dir):
    st = _stats(spark, sf_dir)
    routed = Z.route_steps(_sessions(spark, sf_dir, IDLE_TTL_MS, st), Z.contains_routes(STEPS))
    out = Z.zip_join(routed, "workpiece", STEPS, group=["session"], stats=st.keyed["seq"])
    return out.select("workpiece", F.col("session").cast("bigint").alias("session"), *ZIP_COLS[1:])


def _write_ttl_sql(select: str, where: str) -> str:
    """Oracle of the write TTL: the lists of every key, event by event, as a recursive query."""
    n = range(1, len(STEPS) + 1)
    item = "STRUCT(w BIGINT, ts BIGINT, ev BIGINT)[]"
    fold = lambda f, sep=", ": sep.join(f(k) for k in n)
    same = "e.session = f.session"
    return (
        "WITH RECURSIVE " + LOG_CTE + ",\n" + CLOCK_CTE + ",\n"
        + f"""g AS (SELECT *, CASE WHEN lag(clock_ms) OVER w IS NULL OR clock_ms - lag(clock_ms) OVER w >= {WRITE_TTL_MS} THEN 1 ELSE 0 END
  AS new_session FROM clocked WINDOW w AS (PARTITION BY workpiece ORDER BY seq)),
ev AS (SELECT workpiece, seq, clock_ms, time_stamp, event_id, content, row_number() OVER w AS rn, sum(new_session) OVER w AS session
  FROM g WINDOW w AS (PARTITION BY workpiece ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fold AS (
  SELECT DISTINCT workpiece, 0::BIGINT AS rn, 0::HUGEINT AS session, 0::BIGINT AS n_tuple, NULL::BIGINT AS renewed, false AS hit,
    {fold(lambda k: f"[]::{item} AS l{k}, NULL::STRUCT(w BIGINT, ts BIGINT, ev BIGINT) AS h{k}, 0::BIGINT AS n{k}")},
    NULL::BIGINT AS trigger_seq, NULL::BIGINT AS trigger_ts, NULL::BIGINT AS trigger_event FROM ev
  UNION ALL
  SELECT workpiece, rn, session, CASE WHEN hit THEN n_tuple + 1 ELSE n_tuple END, CASE WHEN hit THEN clock_ms ELSE renewed END, hit,
    {fold(lambda k: f"CASE WHEN hit THEN m{k}[2:] ELSE m{k} END, m{k}[1], len(m{k})")}, seq, time_stamp, event_id
  FROM (SELECT *, {fold(lambda k: f"len(m{k}) > 0", " AND ")} AS hit
    FROM (SELECT e.*, CASE WHEN {same} THEN f.n_tuple ELSE 0 END AS n_tuple, CASE WHEN {same} THEN f.renewed END AS renewed,
      {fold(lambda k: f"list_filter(list_concat(CASE WHEN {same} THEN f.l{k} ELSE []::{item} END, CASE WHEN contains(e.content, '{STEPS[k - 1]}') THEN [struct_pack(w := e.clock_ms, ts := e.time_stamp, ev := e.event_id)] ELSE []::{item} END), lambda x: greatest(x.w, CASE WHEN {same} THEN coalesce(f.renewed, x.w) ELSE x.w END) + {WRITE_TTL_MS} > e.clock_ms) AS m{k}")}
      FROM fold f JOIN ev e ON e.workpiece = f.workpiece AND e.rn = f.rn + 1)))
SELECT {select} FROM fold WHERE {where}"""
    )


@query(
    "zip_join_write_ttl",
    _write_ttl_sql(
        "workpiece, session::BIGINT AS session, n_tuple, "
        + ", ".join(f"h{k + 1}.ts AS {s}_ts, h{k + 1}.ev AS {s}_event" for k, s in enumerate(STEPS))
        + ", trigger_seq, trigger_ts, trigger_event",
        "hit",
    ),
)
def zip_join_write_ttl(spark, sf_dir):
    st = _stats(spark, sf_dir)
    clocked = running_max(_log(spark, sf_dir), ts="time_stamp", out="clock_ms", stats=st["seq"])
    return Z.zip_join_write_ttl(clocked, "workpiece", Z.contains_routes(STEPS), WRITE_TTL_MS, stats=st.keyed["seq"])


@query(
    "zip_pending_sizes_write_ttl",
    _write_ttl_sql(
        "workpiece, trigger_event AS event_id, " + ", ".join(f"n{k + 1}" for k in range(len(STEPS))), "rn > 0"
    ),
)
def zip_pending_sizes_write_ttl(spark, sf_dir):
    """List sizes per event as the TTL job prints them (write TTL, expired elements invisible)."""
    st = _stats(spark, sf_dir)
    clocked = running_max(_log(spark, sf_dir), ts="time_stamp", out="clock_ms", stats=st["seq"])
    return Z.pending_sizes_write_ttl(
        clocked, "workpiece", Z.contains_routes(STEPS), WRITE_TTL_MS, stats=st.keyed["seq"]
    ).drop("session")


# ---------------------------------------------------------------- M4: sequence pattern
from tidemark import jobs as J  # noqa: E402
from tidemark.operators import sequence as C  # noqa: E402


def step_pattern(content: str = "content") -> C.SequencePattern:
    """The reference's pattern: step1, then step2, step3, step4, by content prefix."""
    return J.step_pattern(STEPS, content)


def _chain_sql(src: str, part: str, order: str, payload: list[str], pred: str = "content") -> str:
    """Oracle of relaxed-contiguity matching: first matching row after, chained backwards."""
    over = f"OVER ({part} ORDER BY {order} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    pl = ", ".join(f"{p} := {p}" for p in payload)
    ctes, prev, cur = [], src, None
    for k in range(len(STEPS) - 1, 0, -1):
        inner = f"struct_pack({pl}{', nx := ' + cur if cur else ''})"
        name = f"x{k}"
        ctes.append(
            f"c{k} AS (SELECT *, first_value(CASE WHEN starts_with({pred}, '{STEPS[k]}') THEN {inner} END IGNORE NULLS) "
            f"{over} AS {name} FROM {prev})"
        )
        prev, cur = f"c{k}", name
    node, conds, cols = "x1", [], []
    for k in range(1, len(STEPS)):
        conds.append(f"{node} IS NOT NULL")
        cols += [f"{node}.{p} AS {STEPS[k]}_{p}" for p in payload]
        node = f"{node}.nx"
    first = [f"{p} AS {STEPS[0]}_{p}" for p in payload]
    sel = ", ".join(first + cols)
    where = " AND ".join([f"starts_with({pred}, '{STEPS[0]}')"] + conds)
    return ",\n".join(ctes), f"SELECT {sel} FROM {prev} WHERE {where}"


def _match_sql(keyed: bool, src: str = "log", extra_ctes: tuple[str, ...] = ()) -> str:
    part = "PARTITION BY workpiece" if keyed else ""
    ctes, sel = _chain_sql(src, part, "time_stamp, seq", ["time_stamp", "event_id"])
    if keyed:
        sel = sel.replace("SELECT ", "SELECT workpiece, ", 1)
    return _with(LOG_CTE, *extra_ctes, ctes) + sel


@query("seq_match_keyed", _match_sql(True))
def seq_match_keyed(spark, sf_dir):
    st = _stats(spark, sf_dir)
    return C.match_sequence(_log(spark, sf_dir), step_pattern(), partition_by=["workpiece"], stats=st.keyed["time_stamp"])


@query("seq_match_global", _match_sql(False))
def seq_match_global(spark, sf_dir):
    st = _stats(spark, sf_dir, keyed=False)
    return C.match_sequence(_log(spark, sf_dir), step_pattern(), partition_by=None, stats=st["time_stamp"])


def _select_sql(inner: str) -> str:
    cols = ", ".join(f"'{s}' AS {s}_name, {s}_time_stamp AS {s}_ts" for s in STEPS)
    return f"SELECT workpiece, {cols}, {len(STEPS)} AS n_events FROM ({inner}) m"


@query("seq_match_select", _select_sql(_match_sql(True)))
def seq_match_select(spark, sf_dir):
    st = _stats(spark, sf_dir)
    m = C.match_sequence(_log(spark, sf_dir), step_pattern(), partition_by=["workpiece"], stats=st.keyed["time_stamp"])
    return C.select_process_data(m, STEPS, keys=["workpiece"])


_UNION_WM_CTE = f"""pm AS (SELECT *,
  max(CASE WHEN station = 1 THEN time_stamp END) OVER w AS pm1,
  max(CASE WHEN station = 2 THEN time_stamp END) OVER w AS pm2
  FROM log WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stamped_log AS (SELECT * EXCLUDE (pm1, pm2),
  CASE WHEN pm1 IS NULL OR pm2 IS NULL THEN NULL ELSE least(pm1, pm2) - {LOG_DELAY_MS + 1} END AS wm_ms FROM pm)"""


def _stamped_log(spark, sf_dir, st) -> DataFrame:
    return stamp_watermark(
        _log(spark, sf_dir), bounded_out_of_orderness(LOG_DELAY_MS), ts="time_stamp", stream="station", streams=[1, 2],
        stats=st["seq"],
    )


@query(
    "seq_match_late_dropped",
    _match_sql(
        True,
        src="on_time_log",
        extra_ctes=(_UNION_WM_CTE, "on_time_log AS (SELECT * FROM stamped_log WHERE wm_ms IS NULL OR time_stamp > wm_ms)"),
    ),
)
def seq_match_late_dropped(spark, sf_dir):
    st = _stats(spark, sf_dir)
    kept = C.drop_late(_stamped_log(spark, sf_dir, st))
    return C.match_sequence(kept, step_pattern(), partition_by=["workpiece"], stats=st.keyed["time_stamp"])


@query(
    "process_tracking",
    _with(
        LOG_CTE,
        _UNION_WM_CTE,
        """clocked AS (SELECT *, max(time_stamp) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  AS clock_ms FROM stamped_log)""",
        f"""g AS (SELECT *, CASE WHEN lag(clock_ms) OVER (PARTITION BY workpiece ORDER BY seq) IS NULL
  OR clock_ms - lag(clock_ms) OVER (PARTITION BY workpiece ORDER BY seq) >= {IDLE_TTL_MS} THEN 1 ELSE 0 END AS new_session FROM clocked)""",
        """s AS (SELECT *, sum(new_session) OVER (PARTITION BY workpiece ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM g)""",
        STEPS_CTE,
        "routed AS (SELECT s.*, steps.step FROM s JOIN steps ON contains(s.content, steps.step))",
        _zip_sql("routed", "workpiece, session"),
    )
    + "SELECT f.workpiece, "
    + ", ".join(f"'{s}' AS {s}_name, f.{s}_ts AS {s}_ts" for s in STEPS)
    + f", {len(STEPS)} AS n_events FROM final f JOIN stamped_log t ON t.event_id = f.trigger_event "
    "WHERE t.wm_ms IS NULL OR f.trigger_ts > t.wm_ms",
)
def process_tracking(spark, sf_dir):
    """Union of two stations -> keyed zip with idle TTL -> non-keyed pattern -> select."""
    return J.track_process(
        _log(spark, sf_dir), bounded_out_of_orderness(LOG_DELAY_MS), STEPS, IDLE_TTL_MS, stats=_stats(spark, sf_dir)
    )


# ---------------------------------------------------------------- M6: sources, sinks, rendering, batch ops
from tidemark.functions import render as R  # noqa: E402
from tidemark.operators import batch as B  # noqa: E402
from tidemark.session import scratch_path  # noqa: E402
from tidemark.sources import lines as S  # noqa: E402
from tidemark.streaming import sinks as K  # noqa: E402


@query("src_collection", "SELECT c_name AS _1 FROM customer")
def src_collection(spark, sf_dir):
    cust = E.table(spark, sf_dir, "customer")
    pairs = cust.select(F.col("c_name").alias("_1"), F.col("c_nationkey").cast("int").alias("_2"))
    return S.first_field(pairs)


@query(
    "src_text_file",
    "SELECT CAST(user_id AS VARCHAR) AS id, " + MS_SQL + " AS time_stamp, value AS temperature FROM events",
)
def src_text_file(spark, sf_dir):
    """Sensor lines written as a text table, scanned back and parsed."""
    path = scratch_path(spark, "sensor-lines")
    E.sensor_lines(spark, sf_dir).select("value").write.text(path)
    rows, _ = parse_sensor_lines(S.text_file(spark, path), mode=FAILFAST, keep=[])
    return rows


@query(
    "sink_bucket_counts",
    "SELECT strftime(ts, '%Y-%m-%d--%H') AS bucket, count(*) AS n_rows FROM events GROUP BY 1",
)
def sink_bucket_counts(spark, sf_dir):
    """Lines written into hourly bucket directories with size rolling, counted back (K3, K4, K6)."""
    lines = K.with_bucket(E.sensor_lines(spark, sf_dir, keep_ts=True), F.col("ts"))
    path = scratch_path(spark, "buckets")
    K.write_text_buckets(lines, path, "bucket")
    back = spark.read.schema("value string, bucket string").text(path)
    return back.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"))


def _render_sql() -> str:
    sensor = (
        "SELECT 'sensor' AS kind, event_id AS ref_id, 'SensorReading{id=''' || id || ''', timeStamp=' || "
        "CAST(time_stamp AS VARCHAR) || ', temperature=' || CAST(temperature AS VARCHAR) || '}' AS line FROM sensor"
    )
    log = (
        "SELECT 'log' AS kind, event_id AS ref_id, 'LogEvent{id=''' || CASE WHEN station = 2 THEN 'workStation_2' "
        "ELSE 'workStation_1' END || ''', workpiece=''' || workpiece || ''', timeStamp=' || CAST(time_stamp AS VARCHAR) "
        "|| ', content=''' || content || '''}' AS line FROM log"
    )
    steps = " || ', ' || ".join(f"'{s}=({s},' || CAST({s}_time_stamp AS VARCHAR) || ')'" for s in STEPS)
    ctes, sel = _chain_sql("log", "PARTITION BY workpiece", "time_stamp, seq", ["time_stamp", "event_id"])
    proc = f"SELECT 'process' AS kind, {STEPS[0]}_event_id AS ref_id, 'ProcessData{{' || {steps} || '}}' AS line FROM m"
    return _with(SENSOR_CTE, LOG_CTE, ctes, f"m AS ({sel})") + f"{sensor} UNION ALL {log} UNION ALL {proc}"


@query("render_rows", _render_sql())
def render_rows(spark, sf_dir):
    sensor = _sensor(spark, sf_dir).select(
        F.lit("sensor").alias("kind"), F.col("event_id").alias("ref_id"), R.render_sensor().alias("line")
    )
    log = E.log_events(spark, sf_dir).select(
        F.lit("log").alias("kind"), F.col("event_id").alias("ref_id"), R.render_log_event().alias("line")
    )
    st = _stats(spark, sf_dir)
    m = C.match_sequence(_log(spark, sf_dir), step_pattern(), partition_by=["workpiece"], stats=st.keyed["time_stamp"])
    proc = C.select_process_data(m.withColumnRenamed(f"{STEPS[0]}_event_id", "ref_id"), STEPS, keys=["ref_id"])
    proc = proc.select(F.lit("process").alias("kind"), "ref_id", R.render_process_data(STEPS).alias("line"))
    return sensor.unionByName(log).unionByName(proc)


@query(
    "sink_labelled_rows",
    _with(*_LATE_CTES)
    + """SELECT event_id, CASE WHEN label = 'too_late' THEN 'later data' ELSE 'main' END AS stream,
  CASE WHEN label = 'too_late' THEN 'later data> ' ELSE '' END || 'SensorReading{id=''' || id || ''', timeStamp=' ||
  CAST(time_stamp AS VARCHAR) || ', temperature=' || CAST(temperature AS VARCHAR) || '}' AS line FROM labelled""",
)
def sink_labelled_rows(spark, sf_dir):
    """Main output printed bare, late side output printed with its label (K1, K2)."""
    lab = _late_labelled(spark, sf_dir)
    main = W.emitted_rows(lab).select(
        "event_id", F.lit("main").alias("stream"), R.labelled(R.render_sensor(), None).alias("line")
    )
    late = W.late_side_output(lab).select(
        "event_id", F.lit("later data").alias("stream"), R.labelled(R.render_sensor(), "later data").alias("line")
    )
    return main.unionByName(late)


@query(
    "batch_filter",
    _with(SENSOR_CTE) + "SELECT event_id, id, temperature FROM sensor WHERE temperature > 100",
)
def batch_filter(spark, sf_dir):
    return _sensor(spark, sf_dir).where(F.col("temperature") > 100).select("event_id", "id", "temperature")


@query(
    "batch_flat_map",
    r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word
FROM documents) WHERE word <> '' GROUP BY word""",
)
def batch_flat_map(spark, sf_dir):
    return B.word_counts(E.table(spark, sf_dir, "documents"))


@query(
    "batch_join",
    """SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def batch_join(spark, sf_dir):
    o = E.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = E.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice"
    )


@query(
    "batch_cogroup",
    """WITH o AS (SELECT o_orderkey AS key, count(*) AS n_orders, round(sum(o_totalprice), 6) AS total_price
  FROM orders GROUP BY 1),
l AS (SELECT l_orderkey AS key, count(*) AS n_lines, round(sum(l_quantity), 6) AS sum_qty FROM lineitem GROUP BY 1)
SELECT coalesce(o.key, l.key) AS key, n_orders, total_price, n_lines, sum_qty FROM o FULL OUTER JOIN l ON o.key = l.key""",
)
def batch_cogroup(spark, sf_dir):
    o = E.table(spark, sf_dir, "orders")
    li = E.table(spark, sf_dir, "lineitem")
    out = B.cogroup_aggregate(
        o, li, "o_orderkey", "l_orderkey",
        {"n_orders": F.count(F.lit(1)), "total_price": F.sum("o_totalprice")},
        {"n_lines": F.count(F.lit(1)), "sum_qty": F.sum("l_quantity")},
    )
    return out.withColumns({"total_price": F.round("total_price", 6), "sum_qty": F.round("sum_qty", 6)})


def _totals(key, orders, lines):
    """A user function over both sides of a key: counts and sums, NULL for an absent side."""

    def side(rows, value):
        n, total = 0, 0.0
        for row in rows:
            n, total = n + 1, total + row[value]
        return (n, round(total, 6)) if n else (None, None)

    yield key, *side(orders, "o_totalprice"), *side(lines, "l_quantity")


@query("batch_cogroup_apply", ORACLE["batch_cogroup"])
def batch_cogroup_apply(spark, sf_dir):
    """Co-group with a user function that iterates over both sides."""
    o = E.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = E.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    schema = "key long, n_orders long, total_price double, n_lines long, sum_qty double"
    return B.cogroup_apply(o, li, "o_orderkey", "l_orderkey", _totals, schema)
