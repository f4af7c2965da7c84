"""Structured Streaming paths on file streams of one record per file (bounded waits only)."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.functions.parse import parse_log_lines, parse_sensor_lines
from tidemark.operators import windows as W
from tidemark.plans.watermark import bounded_out_of_orderness
from tidemark.sources import lines as S
from tidemark.streaming import joins as SJ
from tidemark.streaming import sinks as K
from tidemark.streaming import stateful as ST
from tidemark.streaming import windows as SW

from fixtures import B1, BASE, L1, L2, STEPS, sensor_block

WAIT_S = 120


def _write_files(lines):
    d = tempfile.mkdtemp(prefix="tm-stream-in-")
    now = time.time() - 1000
    for i, line in enumerate(lines):
        p = os.path.join(d, f"{i + 1:05d}.txt")
        with open(p, "w") as f:
            f.write(line + "\n")
        os.utime(p, (now + i, now + i))
    return d


def _stream(spark, d, per_trigger=1):
    raw = S.paced_file_reader(spark, per_trigger).load(d)
    return raw.withColumn("seq", F.regexp_extract(F.input_file_name(), r"(\d+)\.txt$", 1).cast("long"))


def _run(writer):
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination(WAIT_S)
    finally:
        q.stop()
    assert q.exception() is None


def _run_until(writer, done, timeout_s=WAIT_S):
    """Processing-time queries may not end by themselves: poll, then stop."""
    q = writer.trigger(availableNow=True).start()
    try:
        deadline = time.time() + timeout_s
        while time.time() < deadline and q.isActive and not done():
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None


def _sensor_lines(block):
    return [f"sensor1,{BASE + s * 1000},{t}" for s, t in block]


@pytest.mark.parametrize("per_trigger", [1, 3])
def test_exact_lateness_stream_equals_batch(spark, per_trigger):
    d = _write_files(_sensor_lines(B1))
    rows, _ = parse_sensor_lines(_stream(spark, d, per_trigger), keep=["seq"])
    out = tempfile.mkdtemp(prefix="tm-stream-out-")
    ck = tempfile.mkdtemp(prefix="tm-stream-ck-")
    fn = SW.ExactLateness(out, bounded_out_of_orderness(5000), 5000, 1000)
    _run(rows.writeStream.foreachBatch(fn).option("checkpointLocation", ck))
    main = spark.read.parquet(f"{out}/main")
    late = spark.read.parquet(f"{out}/late")
    batch = J.window_job(sensor_block(spark, B1), bounded_out_of_orderness(5000), 5000, 1000)
    got = sorted((r["seq"], r["label"]) for r in main.unionByName(late).collect())
    want = sorted((r["seq"], r["label"]) for r in batch.collect())
    assert got == want
    assert [(r["time_stamp"] - BASE) // 1000 for r in late.collect()] == [4]
    key = lambda r: (r["window_start"], r["pane"], r["n_rows"], r["sum_value"])
    assert sorted(map(key, fn.panes(spark, "id", "temperature", row_id="seq").collect())) == sorted(
        map(key, W.refire_panes(batch, "id", "temperature").collect())
    )


def test_plain_watermark_window_aggregate_with_sentinel_flush(spark):
    spec = bounded_out_of_orderness(5000)
    sentinel = SW.flush_sentinel_ms(BASE + 20_000, spec, 5000)
    d = _write_files(_sensor_lines(B1) + [f"sensor1,{sentinel},0"])
    rows, _ = parse_sensor_lines(_stream(spark, d), keep=["seq"])
    got = []
    _run(
        SW.stream_window_aggregate(rows, spec, 5000)
        .writeStream.outputMode("append")
        .foreachBatch(lambda b, i: got.extend(b.collect()))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-"))
    )
    windows = {(r["window_start"] - BASE) // 1000: r["n_rows"] for r in got}
    assert set(windows) == {0, 5, 10, 15, 20}
    assert windows[10] == 1 and windows[15] == 1 and windows[20] == 1


def _log_stream(spark, rows, per_trigger):
    ordered = sorted(rows, key=lambda r: r[2])
    d = _write_files([f"{a}, {b}, {BASE + t}, {c}" for a, b, t, c in ordered])
    raw = _stream(spark, d, per_trigger).withColumn("event_id", F.col("seq"))
    parsed, _ = parse_log_lines(raw, keep=["seq", "event_id"])
    return parsed


@pytest.mark.parametrize("ttl", [None, 3_600_000])
def test_stateful_zip_stream(spark, ttl):
    events = _log_stream(spark, L1 + L2, 2)
    got = []
    _run_until(
        ST.zip_stream(events, "workpiece", STEPS, ttl)
        .writeStream.outputMode("append")
        .foreachBatch(lambda b, i: got.extend(b.collect()))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-")),
        lambda: len(got) >= 2,
    )
    tuples = sorted(tuple(r[f"{s}_ts"] - BASE for s in STEPS) for r in got)
    assert tuples == [(0, 1000, 3000, 4000), (5000, 6000, 7000, 8000)]
    assert sorted(r["trigger_ts"] - BASE for r in got) == [4000, 8000]


def test_bucketed_text_file_sink(spark):
    d = _write_files(_sensor_lines(B1))
    raw = _stream(spark, d, 3).withColumn("line", F.col("value"))
    rows, _ = parse_sensor_lines(raw, keep=["seq", "line"])
    bucketed = K.with_bucket(rows, F.timestamp_millis("time_stamp"))
    out = tempfile.mkdtemp(prefix="tm-sink-")
    w = K.text_file_sink(bucketed, out, tempfile.mkdtemp(prefix="tm-ck-"), value="line", trigger="1 second")
    q = w.trigger(availableNow=True).start()
    q.awaitTermination(WAIT_S)
    q.stop()
    back = spark.read.schema("value string, bucket string").text(out)
    assert back.count() == len(B1)
    assert {r["bucket"] for r in back.collect()} == {"2001-09-09--01"}


def test_interval_join_of_two_streams(spark):
    left = _log_stream(spark, L2, 2)
    right = _log_stream(spark, L1, 2)
    got = []
    joined = SJ.interval_join(left, right, "workpiece", bounded_out_of_orderness(5000), 1500)
    _run(
        joined.writeStream.outputMode("append")
        .foreachBatch(lambda b, i: got.extend(b.collect()))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-"))
    )
    pairs = sorted(((r["l_time_stamp"] - BASE), (r["r_time_stamp"] - BASE)) for r in got)
    assert pairs == [(0, 1000), (3000, 4000), (5000, 4000), (5000, 6000), (7000, 6000), (7000, 8000)]


def test_emitted_rows_of_exact_path_feed_pane_aggregates(spark):
    lab = J.window_job(sensor_block(spark, B1), bounded_out_of_orderness(5000), 5000, 1000)
    assert W.refire_panes(lab, "id", "temperature").count() == 7


def test_pattern_stream_in_event_time_order(spark):
    from tidemark.streaming import pattern as SP

    spec = bounded_out_of_orderness(5000)
    # arrival out of time order: step2@1000 arrives after step3@3000
    rows = [("s", "wp1", 0, "step1"), ("s", "wp1", 3000, "step3"), ("s", "wp1", 1000, "step2"),
            ("s", "wp1", 4000, "step4"), ("s", "wp1", 5000, "step1"), ("s", "wp1", 6000, "step2"),
            ("s", "wp1", 7000, "step3"), ("s", "wp1", 8000, "step4"), ("s", "wp1", 60_000, "error")]
    d = _write_files([f"{a}, {b}, {BASE + t}, {c}" for a, b, t, c in rows])
    raw = _stream(spark, d, 2).withColumn("event_id", F.col("seq"))
    events, _ = parse_log_lines(raw, keep=["seq", "event_id"])
    got = []
    _run(
        SP.match_stream(events, J.step_pattern(STEPS), "workpiece", spec)
        .writeStream.outputMode("append")
        .foreachBatch(lambda b, i: got.extend(b.collect()))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-"))
    )
    assert sorted(tuple(r[f"{s}_ts"] - BASE for s in STEPS) for r in got) == [(0, 1000, 3000, 4000), (5000, 6000, 7000, 8000)]


def test_print_sink_with_label_runs(spark, capfd):
    d = _write_files(_sensor_lines(B1[:3]))
    rows, _ = parse_sensor_lines(_stream(spark, d, 3), keep=["seq"])
    from tidemark.functions import render as R

    lines = rows.select(R.labelled(R.render_sensor(), "later data").alias("line"))
    q = K.print_sink(lines, "later data", tempfile.mkdtemp(prefix="tm-ck-")).trigger(availableNow=True).start()
    q.awaitTermination(WAIT_S)
    q.stop()
    assert q.exception() is None and q.name == "later data"


def test_single_global_bucket_write(spark):
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    out = os.path.join(tempfile.mkdtemp(prefix="tm-sink-"), "global")
    K.write_text_buckets(df, out, bucket=None)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["a", "b"]


def test_exact_lateness_on_a_union_of_sources(spark):
    """Two stations in one stream: watermark = min of the stations' own, per row."""
    from tidemark.plans.watermark import stamp_watermark

    rows = [("workStation_1", "wp1", 0, "step1"), ("workStation_1", "wp1", 9000, "step3"),
            ("workStation_2", "wp1", 1000, "step2"), ("workStation_1", "wp1", 12000, "step1"),
            ("workStation_2", "wp1", 2000, "step4"), ("workStation_2", "wp1", 20000, "step2"),
            ("workStation_1", "wp1", 3000, "step3")]
    d = _write_files([f"{a}, {b}, {BASE + t}, {c}" for a, b, t, c in rows])
    raw = _stream(spark, d, 2)
    events, _ = parse_log_lines(raw, keep=["seq"])
    events = events.withColumn("station", F.when(F.col("id") == "workStation_2", 2).otherwise(1))
    out = tempfile.mkdtemp(prefix="tm-stream-out-")
    spec = bounded_out_of_orderness(5000)
    fn = SW.ExactLateness(out, spec, 5000, 0, stream="station", streams=[1, 2])
    _run(events.writeStream.foreachBatch(fn).option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-")))
    got = {r["seq"]: (r["wm_ms"], r["label"]) for r in fn.main_rows(spark).unionByName(fn.late_rows(spark)).collect()}
    lines = spark.createDataFrame([(i + 1, f"{a}, {b}, {BASE + t}, {c}") for i, (a, b, t, c) in enumerate(rows)],
                                  "seq long, value string")
    parsed, _ = parse_log_lines(lines, keep=["seq"])
    parsed = parsed.withColumn("station", F.when(F.col("id") == "workStation_2", 2).otherwise(1))
    batch = W.label_lateness(
        stamp_watermark(parsed, spec, ts="time_stamp", stream="station", streams=[1, 2]), 5000, ts="time_stamp"
    )
    want = {r["seq"]: (r["wm_ms"], r["label"]) for r in batch.collect()}
    assert got == want
    assert want[7][1] == "too_late"  # station 1 at 3 s after both stations passed 9 s / 20 s
