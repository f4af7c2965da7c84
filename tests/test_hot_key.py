"""A key holding most rows takes the bucketed path and still equals a sequential brute force."""

import random

from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.operators import sequence as C
from tidemark.operators import zipjoin as Z
import pytest

from tidemark.plans import scan as scan_mod

STEPS = ("step1", "step2", "step3", "step4")


@pytest.fixture(autouse=True)
def small_direct_bound(monkeypatch):
    """Shrink the plain-window bound so that these inputs take the bucketed path."""
    monkeypatch.setattr(scan_mod, "DIRECT_MAX_ROWS", 4096)


def _events(spark, n=50_000, seed=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        wp = "hot" if rng.random() < 0.75 else f"wp{rng.randrange(50)}"
        rows.append((i, i, i * 10, wp, rng.choice(STEPS + ("error",))))
    df = spark.createDataFrame(rows, "event_id long, seq long, time_stamp long, workpiece string, content string")
    return rows, df


def _brute_zip(rows):
    lists, out, count = {}, set(), {}
    for eid, seq, ts, wp, c in rows:
        ls = lists.setdefault(wp, [[] for _ in STEPS])
        for k, s in enumerate(STEPS):
            if s in c:
                ls[k].append(eid)
        if all(ls):
            count[wp] = count.get(wp, 0) + 1
            out.add((wp, count[wp], *[lst.pop(0) for lst in ls], eid))
    return out


def test_zip_with_hot_key_is_bucketed_and_exact(spark):
    rows, df = _events(spark)
    st = J.base_stats(df)
    assert st.keyed["seq"].n > scan_mod.DIRECT_MAX_ROWS  # forces buckets for keyed scans
    out = Z.zip_join(Z.route_steps(df, Z.contains_routes(STEPS)), "workpiece", STEPS, stats=st.keyed["seq"])
    got = {(r["workpiece"], r["n_tuple"], *[r[f"{s}_event"] for s in STEPS], r["trigger_event"]) for r in out.collect()}
    assert got == _brute_zip(rows)


def test_global_match_over_many_buckets(spark):
    rows, df = _events(spark, n=40_000, seed=3)
    m = C.match_sequence(df, J.step_pattern(STEPS), partition_by=None)
    # brute force: first row after, chained
    order = sorted(rows, key=lambda r: (r[2], r[1]))
    nxt = {}
    for k, s in enumerate(STEPS):
        later = None
        for r in reversed(order):
            nxt[(k, r[0])] = later
            if r[4].startswith(s):
                later = r[0]
    expect = set()
    for r in order:
        if r[4].startswith(STEPS[0]):
            chain, cur = [r[0]], r[0]
            for k in range(1, len(STEPS)):
                cur = nxt[(k, cur)]
                if cur is None:
                    break
                chain.append(cur)
            if len(chain) == len(STEPS):
                expect.add(tuple(chain))
    got = {tuple(r[f"{s}_event_id"] for s in STEPS) for r in m.collect()}
    assert got == expect
    assert m.where(F.col("step1_event_id").isNull()).count() == 0


def test_hot_timestamp_is_split_by_dense_ordinal(spark, monkeypatch):
    """A third of the rows share one event time; composite (ts, seq) scans still bucket exactly."""
    monkeypatch.setattr(scan_mod, "DIRECT_MAX_ROWS", 256)  # ~670 rows per key share the hot timestamp
    from tidemark.operators import windows as W
    from tidemark.plans.ordinal import with_ordinal

    rng = random.Random(9)
    rows = []
    for i in range(6000):
        ts = 5_000 if i % 3 == 0 else rng.randrange(0, 10_000)
        rows.append((i, rng.randrange(10**6), ts, f"wp{rng.randrange(3)}", rng.choice(STEPS)))
    # unique seq per row
    rows = [(eid, eid * 7 + 3, ts, wp, c) for eid, _, ts, wp, c in rows]
    df = spark.createDataFrame(rows, "event_id long, seq long, time_stamp long, workpiece string, content string")

    stats = scan_mod.order_stats(df, "time_stamp")
    assert not scan_mod.lead_is_balanced(df, "time_stamp", ["workpiece"], stats)  # ordinal path taken

    ords = {r["event_id"]: r["__ord"] for r in with_ordinal(df, ["time_stamp", "seq"]).collect()}
    expect = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[1])))}
    assert ords == expect

    pos = W.sorted_window_rows(
        df.withColumns({"window_start": F.lit(0)}), "workpiece", ts="time_stamp", order="seq"
    ).collect()
    want = {}
    for wp in {r[3] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[3] == wp), key=lambda r: (r[2], r[1]))):
            want[r[0]] = i + 1
    assert {r["event_id"]: r["pos"] for r in pos} == want

    m = C.match_sequence(df, J.step_pattern(STEPS), partition_by=["workpiece"])
    order = {}
    for wp in {r[3] for r in rows}:
        order[wp] = sorted((r for r in rows if r[3] == wp), key=lambda r: (r[2], r[1]))
    expect_m = set()
    for wp, seq in order.items():
        for i, r in enumerate(seq):
            if not r[4].startswith(STEPS[0]):
                continue
            chain, j = [r[0]], i
            for s in STEPS[1:]:
                j = next((k for k in range(j + 1, len(seq)) if seq[k][4].startswith(s)), None)
                if j is None:
                    break
                chain.append(seq[j][0])
            if len(chain) == len(STEPS):
                expect_m.add(tuple(chain))
    assert {tuple(r[f"{s}_event_id"] for s in STEPS) for r in m.collect()} == expect_m
