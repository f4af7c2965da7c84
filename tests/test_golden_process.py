"""Zip join, TTL and pattern matching on the sample process logs (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.operators import sequence as C
from tidemark.operators import zipjoin as Z
from tidemark.plans.watermark import bounded_out_of_orderness, running_max

from fixtures import BASE, L1, L2, STEPS, log_events


def _tuples(df):
    return sorted(tuple(r[f"{s}_ts"] - BASE for s in STEPS) + (r["trigger_ts"] - BASE,) for r in df.collect())


def test_zip_without_ttl(spark):
    ev = log_events(spark, L1 + L2)
    out = Z.zip_join(Z.route_steps(ev, Z.contains_routes(STEPS)), "workpiece", STEPS)
    assert _tuples(out) == [(0, 1000, 3000, 4000, 4000), (5000, 6000, 7000, 8000, 8000)]


def test_zip_station2_alone_and_pending_sizes(spark):
    ev = log_events(spark, L2)
    assert Z.zip_join(Z.route_steps(ev, Z.contains_routes(STEPS)), "workpiece", STEPS).count() == 0
    sizes = Z.pending_sizes(ev, "workpiece", Z.contains_routes(STEPS)).orderBy("seq").collect()
    assert [(r["n1"], r["n2"], r["n3"], r["n4"]) for r in sizes][-1] == (2, 0, 2, 0)


def test_pending_sizes_before_pop(spark):
    ev = log_events(spark, L1 + L2)
    sizes = Z.pending_sizes(ev, "workpiece", Z.contains_routes(STEPS)).orderBy("seq").collect()
    got = [(r["n1"], r["n2"], r["n3"], r["n4"]) for r in sizes]
    assert got[3] == (1, 1, 1, 1)  # step4@4000 completes the first tuple: sizes printed before the pop
    assert got[4] == (1, 0, 0, 0)
    assert got[7] == (1, 1, 1, 1)


def _idle(spark, rows, ttl):
    ev = running_max(log_events(spark, rows), ts="time_stamp", out="clock_ms")
    sess = Z.gap_sessions(ev, "workpiece", ttl)
    return Z.zip_join(Z.route_steps(sess, Z.contains_routes(STEPS)), "workpiece", STEPS, group=["session"])


@pytest.mark.parametrize(
    "ttl,expected",
    [
        (20_000, [(0, 1000, 3000, 4000, 4000), (5000, 6000, 7000, 8000, 8000)]),
        (1_000, []),
        (2_000, [(5000, 6000, 3000, 4000, 6000)]),
    ],
)
def test_zip_idle_ttl(spark, ttl, expected):
    assert _tuples(_idle(spark, L1 + L2, ttl)) == expected


def _write(spark, rows, ttl):
    ev = running_max(log_events(spark, rows), ts="time_stamp", out="clock_ms")
    return Z.zip_join_write_ttl(ev, "workpiece", Z.contains_routes(STEPS), ttl)


@pytest.mark.parametrize(
    "ttl,expected",
    [(1_000, []), (4_000, [(5000, 6000, 3000, 4000, 6000)]),
     (10**9, [(0, 1000, 3000, 4000, 4000), (5000, 6000, 7000, 8000, 8000)])],
)
def test_zip_write_ttl(spark, ttl, expected):
    assert _tuples(_write(spark, L1 + L2, ttl)) == expected


def test_write_ttl_pop_renews_survivors(spark):
    rows = [("s", "wp1", 0, "step1"), ("s", "wp1", 500, "step1"), ("s", "wp1", 900, "step2"),
            ("s", "wp1", 1000, "step3"), ("s", "wp1", 1400, "step4"), ("s", "wp1", 2600, "step2"),
            ("s", "wp1", 2700, "step3"), ("s", "wp1", 2800, "step4")]
    assert _tuples(_write(spark, rows, 2_000)) == [(0, 900, 1000, 1400, 1400), (500, 2600, 2700, 2800, 2800)]


def test_write_ttl_fold_equals_brute_force_and_plain_zip(spark):
    """Without expiry the sequential fold equals the closed-form zip (property)."""
    import random

    rng = random.Random(5)
    rows, t = [], 0
    for _ in range(300):
        t += rng.randint(1, 50)
        rows.append(("s", f"wp{rng.randrange(4)}", t, rng.choice(STEPS + ("error",))))
    ev = running_max(log_events(spark, rows), ts="time_stamp", out="clock_ms")
    a = Z.zip_join_write_ttl(ev, "workpiece", Z.contains_routes(STEPS), 10**12)
    b = Z.zip_join(Z.route_steps(ev, Z.contains_routes(STEPS)), "workpiece", STEPS)
    key = lambda r: (r["workpiece"], r["n_tuple"], *[r[f"{s}_event"] for s in STEPS], r["trigger_event"])
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_match_directly_on_events(spark):
    ev = log_events(spark, L1 + L2)
    m = C.match_sequence(ev, J.step_pattern(STEPS), partition_by=["workpiece"])
    got = sorted(tuple(r[f"{s}_time_stamp"] - BASE for s in STEPS) for r in m.collect())
    assert got == [(0, 1000, 3000, 4000), (5000, 6000, 7000, 8000)]
    g = C.match_sequence(ev, J.step_pattern(STEPS), partition_by=None)
    assert g.count() == 2


def test_process_tracking_pipeline(spark):
    ev = log_events(spark, L1 + L2)
    out = J.track_process(ev, bounded_out_of_orderness(5000), STEPS, idle_ttl_ms=20_000)
    rows = out.collect()
    assert sorted(tuple(r[f"{s}_ts"] - BASE for s in STEPS) for r in rows) == [(0, 1000, 3000, 4000), (5000, 6000, 7000, 8000)]
    assert all(r["n_events"] == 4 for r in rows)
    assert rows[0]["step1_name"] == "step1"


def test_process_tracking_out_of_time_order_tuple(spark):
    ev = log_events(spark, L1 + L2)
    out = J.track_process(ev, bounded_out_of_orderness(5000), STEPS, idle_ttl_ms=2_000)
    assert [tuple(r[f"{s}_ts"] - BASE for s in STEPS) for r in out.collect()] == [(5000, 6000, 3000, 4000)]


def test_pattern_skips_non_matching_and_each_start_matches_once(spark):
    rows = [("s", "w", 0, "step1"), ("s", "w", 1, "step1"), ("s", "w", 2, "error"), ("s", "w", 3, "step2"),
            ("s", "w", 4, "step3"), ("s", "w", 5, "step2"), ("s", "w", 6, "step4")]
    ev = log_events(spark, rows)
    m = C.match_sequence(ev, J.step_pattern(STEPS), partition_by=["workpiece"])
    got = sorted(tuple(r[f"{s}_time_stamp"] - BASE for s in STEPS) for r in m.collect())
    assert got == [(0, 3, 4, 6), (1, 3, 4, 6)]


def test_late_rows_are_dropped_before_matching(spark):
    rows = [("s", "w", 10_000, "step1"), ("s", "w", 20_000, "error"), ("s", "w", 11_000, "step2"),
            ("s", "w", 21_000, "step2"), ("s", "w", 22_000, "step3"), ("s", "w", 23_000, "step4")]
    ev = log_events(spark, rows).drop("seq").withColumn("seq", F.col("event_id"))
    # arrival order = list order (not time order); watermark 5 s
    ordered = [(i + 1, r) for i, r in enumerate(rows)]
    assert len(ordered) == 6
    from tidemark.plans.watermark import stamp_watermark

    lines = spark.createDataFrame(
        [(i, f"{a}, {b}, {BASE + t}, {c}") for i, (a, b, t, c) in ordered], "seq long, value string"
    ).withColumn("event_id", F.col("seq"))
    from tidemark.functions.parse import parse_log_lines

    parsed, _ = parse_log_lines(lines)
    stamped = stamp_watermark(parsed, bounded_out_of_orderness(5000), ts="time_stamp")
    kept = C.drop_late(stamped)
    m = C.match_sequence(kept, J.step_pattern(STEPS), partition_by=["workpiece"])
    # step2@11000 arrives after 20000 was seen (wm 14999): dropped, so step2@21000 is used
    assert [tuple(r[f"{s}_time_stamp"] - BASE for s in STEPS) for r in m.collect()] == [(10_000, 21_000, 22_000, 23_000)]
    assert ev.count() == 6


def test_pending_sizes_with_write_ttl(spark):
    # station 1 alone, 1 s write TTL, arrivals 0, 3000, 5000, 7000: every element
    # has expired by the next arrival, so each event sees only itself
    ev = running_max(log_events(spark, L2), ts="time_stamp", out="clock_ms")
    sizes = Z.pending_sizes_write_ttl(ev, "workpiece", Z.contains_routes(STEPS), 1_000).collect()
    got = [(r["n1"], r["n2"], r["n3"], r["n4"]) for r in sorted(sizes, key=lambda r: r["event_id"])]
    assert got == [(1, 0, 0, 0), (0, 0, 1, 0), (1, 0, 0, 0), (0, 0, 1, 0)]
    # without expiry the fold equals the closed form
    big = Z.pending_sizes_write_ttl(ev, "workpiece", Z.contains_routes(STEPS), 10**12).collect()
    closed = Z.pending_sizes(ev, "workpiece", Z.contains_routes(STEPS)).collect()
    key = lambda r: (r["event_id"], r["n1"], r["n2"], r["n3"], r["n4"])
    assert sorted(map(key, big)) == sorted(map(key, closed))


def test_event_in_two_lists_is_matched_by_its_content(spark):
    """Routing uses 'contains', the pattern 'startswith' on the event's own content."""
    rows = [("s", "wp1", 0, "step1+step2"), ("s", "wp1", 1000, "step3"), ("s", "wp1", 2000, "step4")]
    ev = log_events(spark, rows)
    tuples = Z.zip_join(Z.route_steps(ev, Z.contains_routes(STEPS)), "workpiece", STEPS)
    assert _tuples(tuples) == [(0, 0, 1000, 2000, 2000)]
    out = J.track_process(ev, bounded_out_of_orderness(5000), STEPS, idle_ttl_ms=None, streams=(1,))
    assert out.count() == 0  # the second zipped row does not start with 'step2'
