"""Queries that run as streams: the ``events`` table replayed in arrival order, results read back.

Each query writes its rows as an ordered folder, stamps them with their exact watermark batch by
batch, and runs the stateful operator over the stamped stream to the end of the input.  The
oracle is the SQL of the batch form: the stream must return the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import queries as Q
from tidemark.operators import sequence as C
from tidemark.plans.watermark import WatermarkSpec, bounded_out_of_orderness
from tidemark.session import scratch_path
from tidemark.streaming import jobs as SJ
from tidemark.streaming import pattern as SP
from tidemark.streaming import replay, stamping
from tidemark.streaming import stateful as ST
from tidemark.streaming import windows as SW
from tidemark.streaming.global_pattern import GlobalPattern

#: Files of a replayed folder, and how many of them a micro-batch takes.
REPLAY_FILES, PER_TRIGGER = 6, 2
#: Bytes of stamped files in a micro-batch of a query.  Stamping writes as many files as there are tasks;
#: a batch of each would cost its start (tens of jobs of the non-keyed pattern) for a few thousand rows.
BATCH_BYTES = 64 << 20


def stamped_replay(spark: SparkSession, rows: DataFrame, spec: WatermarkSpec, stream: str | None = None, streams=(),
                   order: str = "seq", batch_bytes: int | None = None) -> DataFrame:
    """``rows`` replayed in ``order``, stamped, as a stream that ends; a batch is a file, or ``batch_bytes`` of them."""
    out = scratch_path(spark, "stream")
    replay.write_ordered(rows, order, f"{out}/source", REPLAY_FILES)
    stamper = stamping.WatermarkStamper(f"{out}/stamped", spec, order=order, stream=stream, streams=streams)
    source = replay.read_ordered(spark, f"{out}/source", rows.schema, PER_TRIGGER)
    replay.run_available(source.writeStream.foreachBatch(stamper), f"{out}/stamping", spark)
    stamper.end(spark, rows.schema)
    return stamper.rows(spark, rows.schema, bytes_per_trigger=batch_bytes)


def collected(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Everything that a stream returns until its input ends."""
    out = scratch_path(spark, "stream-out")
    writer = stream.writeStream.format("parquet").option("path", f"{out}/rows").outputMode("append")
    replay.run_available(writer, f"{out}/checkpoint", spark)
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


def matched(spark: SparkSession, stream: DataFrame, pattern: C.SequencePattern, order, payload, before: str, after: str) -> DataFrame:
    """Non-keyed matches of a stream until its input ends."""
    out = scratch_path(spark, "stream-match")
    fold = GlobalPattern(f"{out}/state", pattern, stream.schema, order, payload, before, after)
    replay.run_available(stream.writeStream.foreachBatch(fold), f"{out}/checkpoint", spark)
    fold.end(spark, fold.last_batch(spark))
    return fold.matches(spark)


def _sensor(spark: SparkSession, sf_dir: str, delay_ms: int) -> DataFrame:
    rows = Q._sensor(spark, sf_dir)
    return stamped_replay(spark, rows, bounded_out_of_orderness(delay_ms), batch_bytes=BATCH_BYTES)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped_replay(
        spark, Q._log(spark, sf_dir), bounded_out_of_orderness(Q.LOG_DELAY_MS), stream="station", streams=[1, 2],
        batch_bytes=BATCH_BYTES,
    )


@Q.query("stream_sorted_rows", Q.ORACLE["win_sorted_rows"])
def stream_sorted_rows(spark, sf_dir):
    """Windows that fire on a stream, their rows in event-time order."""
    return collected(spark, SW.sorted_rows_stream(_sensor(spark, sf_dir, Q.SORTED_DELAY_MS), "id", Q.SORTED_SIZE_MS))


@Q.query("stream_refire_panes", Q.ORACLE["win_refire_panes"])
def stream_refire_panes(spark, sf_dir):
    """Bounded re-fire on a stream: one pane per allowed-late row (L2)."""
    panes = SW.refire_panes_stream(_sensor(spark, sf_dir, Q.DELAY_MS), "id", "temperature", Q.SIZE_MS, Q.LATENESS_MS)
    return collected(spark, panes).withColumn("sum_value", F.round("sum_value", 6))


@Q.query("stream_apply_udf", Q.ORACLE["win_apply_udf"])
def stream_apply_udf(spark, sf_dir):
    """A user window function on a stream (W2, UF2, UF3)."""
    stamped = _sensor(spark, sf_dir, Q.DELAY_MS)
    return collected(spark, SW.apply_window_stream(stamped, "id", Q.SIZE_MS, Q._spread_rows, Q.SPREAD, ["event_id", "temperature"]))


@Q.query("stream_zip_idle_ttl", Q.ORACLE["zip_join_idle_ttl"])
def stream_zip_idle_ttl(spark, sf_dir):
    """The keyed FIFO zip on a stream, emptied by idle gaps on the event-time clock (Z1, Z2, ST1, ST2)."""
    tuples = ST.zip_stream(_log(spark, sf_dir), "workpiece", Q.STEPS, Q.IDLE_TTL_MS, idle=True, clock="clock_ms", keep_sessions=True)
    return collected(spark, tuples).select("workpiece", "session", *Q.ZIP_COLS[1:])


@Q.query("stream_match_keyed", Q.ORACLE["seq_match_late_dropped"])
def stream_match_keyed(spark, sf_dir):
    """The keyed pattern on a stream, late rows dropped by their stamps."""
    rows = C.drop_late(_log(spark, sf_dir))
    matches = SP.match_stream(rows, Q.step_pattern(), "workpiece", payload=["time_stamp", "event_id"])
    return collected(spark, matches)


@Q.query(
    "stream_match_global",
    Q._match_sql(
        False,
        src="on_time_log",
        extra_ctes=(Q._UNION_WM_CTE, "on_time_log AS (SELECT * FROM stamped_log WHERE wm_ms IS NULL OR time_stamp > wm_ms)"),
    ),
)
def stream_match_global(spark, sf_dir):
    """The pattern over a stream without a key, batches summarised in parallel (C4)."""
    return matched(spark, _log(spark, sf_dir), Q.step_pattern(), ["time_stamp", "seq"], ["time_stamp", "event_id"], "wm_ms", "after_ms")


@Q.query("stream_process_tracking", Q.ORACLE["process_tracking"])
def stream_process_tracking(spark, sf_dir):
    """Process tracking on a stream: union, keyed zip with idle TTL, pattern without a key, select."""
    rows = SJ.zipped_rows(_log(spark, sf_dir), Q.STEPS, Q.IDLE_TTL_MS)
    matches = matched(spark, rows, Q.step_pattern(), SJ.ZIPPED_ORDER, ["row_ts", "workpiece"], "trigger_wm_ms", "trigger_after_ms")
    return SJ.select_tracked(matches, Q.STEPS)


@Q.query("stream_process_tracking_keyed", Q.ORACLE["process_tracking"])
def stream_process_tracking_keyed(spark, sf_dir):
    """Process tracking in one streaming query of two chained stateful operators."""
    return collected(spark, SJ.track_process_stream(_log(spark, sf_dir), Q.STEPS, Q.IDLE_TTL_MS))
