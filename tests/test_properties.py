"""Cross-operator properties on the driver's events table."""

from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark import queries as Q
from tidemark.operators import windows as W
from tidemark.operators import zipjoin as Z
from tidemark.plans.watermark import bounded_out_of_orderness, running_max, stamp_watermark

SF = "/root/testdata/sf0.001"


def test_process_tracking_is_the_zip_minus_late_triggers(spark):
    log = Q._log(spark, SF)
    spec = bounded_out_of_orderness(Q.LOG_DELAY_MS)
    stamped = stamp_watermark(log, spec, ts="time_stamp", stream="station", streams=[1, 2])
    clocked = running_max(stamped, ts="time_stamp", out="clock_ms")
    sessions = Z.gap_sessions(clocked, "workpiece", Q.IDLE_TTL_MS)
    tuples = Z.zip_join(Z.route_steps(sessions, Z.contains_routes(Q.STEPS)), "workpiece", Q.STEPS,
                        group=["session"], carry=["wm_ms"])
    on_time = tuples.where(F.col("trigger_wm_ms").isNull() | (F.col("trigger_ts") > F.col("trigger_wm_ms")))
    want = sorted(tuple(r[f"{s}_ts"] for s in Q.STEPS) for r in on_time.collect())
    got = sorted(tuple(r[f"{s}_ts"] for s in Q.STEPS) for r in J.track_process(log, spec, Q.STEPS, Q.IDLE_TTL_MS).collect())
    assert got == want and len(got) > 0


def test_labels_partition_the_input(spark):
    sensor = Q._sensor(spark, SF)
    lab = J.window_job(sensor, bounded_out_of_orderness(Q.DELAY_MS), Q.SIZE_MS, Q.LATENESS_MS)
    n = sensor.count()
    assert lab.count() == n
    assert W.emitted_rows(lab).count() + W.late_side_output(lab).count() == n
    assert {r["label"] for r in lab.select("label").distinct().collect()} <= {"on_time", "allowed_late", "too_late"}
