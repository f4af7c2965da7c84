"""Stamped streams: state by position, expiry, linked partial matches, windows that fire, non-keyed patterns."""

import random
import tempfile
import time
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark import queries as Q
from tidemark import stream_queries
from tidemark.operators import sequence as C
from tidemark.operators import windows as W
from tidemark.operators import zipjoin as Z
from tidemark.plans.watermark import bounded_out_of_orderness, stamp_watermark
from tidemark.stream_queries import collected, matched, stamped_replay
from tidemark.streaming import pattern as SP
from tidemark.streaming import replay, stamping
from tidemark.streaming import stateful as ST
from tidemark.streaming import windows as SW
from tidemark.streaming.global_pattern import GlobalPattern

from fixtures import STEPS

LOG = "seq long, event_id long, workpiece string, station int, time_stamp long, content string"
SPEC = bounded_out_of_orderness(3000)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every batch of a stateful query opens a state store and a worker per partition."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


class Counted:
    """Map, value and timer state that counts how often it is read and written."""

    def __init__(self):
        self.maps, self.values, self.timers, self.reads, self.writes = {}, {}, [], 0, 0

    def getMapState(self, name, *_):
        outer, items = self, self.maps.setdefault(name, {})

        class Map:
            def getValue(self, key):
                outer.reads += 1
                return items[key]

            def containsKey(self, key):
                return key in items

            def updateValue(self, key, value):
                outer.writes += 1
                items[key] = value

            def removeKey(self, key):
                outer.writes += 1
                del items[key]

            def clear(self):
                items.clear()

        return Map()

    def getValueState(self, name, *_):
        outer = self

        class Value:
            def exists(self):
                return outer.values.get(name) is not None

            def get(self):
                return outer.values[name]

            def update(self, value):
                outer.values[name] = value

            def clear(self):
                outer.values[name] = None

        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


class Times:
    def __init__(self, now=0):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentWatermarkInMs


def log_rows(n, seed, keys=4, gap=1000, noise=0.2):
    """Events of two stations in arrival order, out of time order, NULL contents among them."""
    r = random.Random(seed)
    rows, t = [], 1_000_000
    for i in range(n):
        t += r.choice([0, 100, gap, 12 * gap if r.random() < 0.05 else gap])
        content = r.choice(["error", None]) if r.random() < noise else r.choice(STEPS)
        rows.append((i * 3, i, f"wp{r.randrange(keys)}", r.choice([1, 2]), t - r.choice([0, 0, 0, 500, 9000]), content))
    return rows


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def stamped_batch(df):
    return stamp_watermark(df, SPEC, ts="time_stamp", stream="station", streams=[1, 2], clock="clock_ms")


def stamped(spark, df):
    return stamped_replay(spark, df, SPEC, stream="station", streams=[1, 2])


def sorted_rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- replay and stamps
def test_ordered_folder_replays_in_order_and_is_written_once(spark):
    out = tempfile.mkdtemp(prefix="tm-replay-") + "/rows"
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("seq")).repartition(8)
    last = replay.write_ordered(df, "seq", out, 5)
    seen = []
    stream = replay.read_ordered(spark, out, "seq long", 2)
    writer = stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted(r["seq"] for r in b.collect())))
    replay.run_available(writer, tempfile.mkdtemp(prefix="tm-ck-"))
    assert len(seen) == 3 and [x for batch in seen for x in batch] == sorted(r["seq"] for r in df.collect())
    assert replay.write_ordered(df.limit(3), "seq", out, 1, after_ms=last) == last
    assert spark.read.parquet(out).count() == 1000  # the folder in place stays
    # what is being written is hidden from a stream that runs already
    df.limit(5).write.parquet(out.replace("rows", "") + ".staging-more")
    above = replay.read_ordered(spark, out.removesuffix("/rows"), "seq long", 100)
    n = []
    replay.run_available(above.writeStream.foreachBatch(lambda b, i: n.append(b.count())), tempfile.mkdtemp(prefix="tm-ck-"))
    assert sum(n) == 1000


def test_stamps_equal_the_batch_and_a_repeated_batch_changes_nothing(spark):
    rows = log_rows(300, 1)
    df = log(spark, rows)
    out = tempfile.mkdtemp(prefix="tm-stamp-")
    stamper = stamping.WatermarkStamper(out, SPEC, stream="station", streams=[1, 2])
    parts = [df.where(F.col("seq").between(a, a + 299)) for a in (0, 300, 600)]
    for k in (0, 1, 1, 2, 2):
        stamper(parts[k], k)
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/rows")
    cols = ["seq", "wm_ms", "clock_ms"]
    key = lambda rows: sorted((r["seq"], r["wm_ms"] if r["wm_ms"] is not None else -1, r["clock_ms"]) for r in rows)
    assert key(got.collect()) == key(stamped_batch(df).select(*cols).collect())
    by_seq = {r["seq"]: r for r in got.collect()}
    order = sorted(by_seq)
    assert all(by_seq[a]["after_ms"] == by_seq[b]["wm_ms"] for a, b in zip(order, order[1:]))


def test_a_batch_of_a_query_takes_the_files_that_its_bytes_hold(spark, tmp_path, monkeypatch):
    """Stamping writes several files a batch; a query on small ones runs a batch, not one per file."""
    events = spark.range(300).selectExpr(
        "id AS event_id", "timestamp_millis(id * 1000) AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0 AS value", "'' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    seen = {}
    for most in (1, stream_queries.BATCH_BYTES):
        monkeypatch.setattr(stream_queries, "BATCH_BYTES", most)
        batches = seen.setdefault(most, [])
        stream = stream_queries._log(spark, str(tmp_path))
        writer = stream.writeStream.foreachBatch(lambda b, i, into=batches: into.append(sorted(r["event_id"] for r in b.collect())))
        replay.run_available(writer, tempfile.mkdtemp(prefix="tm-ck-"))
    few, many = (sorted(seen[k], key=len)[::-1] for k in sorted(seen, reverse=True))
    assert len([b for b in few if b]) == 1 and len([b for b in many if b]) > 2
    assert sorted(sum(many, [])) == few[0] == list(range(300))


# ---------------------------------------------------------------- zip by position, expiry
@pytest.mark.parametrize("seed", [2, 3])
def test_zip_with_idle_expiry_on_the_event_clock_equals_batch(spark, seed):
    df = log(spark, log_rows(400, seed))
    stream = ST.zip_stream(stamped(spark, df), "workpiece", STEPS, 9000, idle=True, clock="clock_ms", keep_sessions=True)
    sessions = Z.gap_sessions(stamped_batch(df), "workpiece", 9000)
    batch = Z.zip_join(Z.route_steps(sessions, Z.contains_routes(STEPS)), "workpiece", STEPS, group=["session"])
    cols = ["workpiece", "session", "n_tuple", "trigger_event", *[f"{s}_event" for s in STEPS]]
    want = sorted_rows(batch, *cols)
    assert max(w[1] for w in want) > 2  # gaps did expire state
    assert sorted_rows(collected(spark, stream), *cols) == want


def test_zip_and_sizes_with_write_expiry_equal_batch(spark):
    df = log(spark, log_rows(400, 5))
    clocked, routes = stamped_batch(df), Z.contains_routes(STEPS)
    cols = ["workpiece", "trigger_event", *[f"{s}_event" for s in STEPS]]
    want = sorted_rows(Z.zip_join_write_ttl(clocked, "workpiece", routes, 6000), *cols)
    free = sorted_rows(Z.zip_join(Z.route_steps(df, routes), "workpiece", STEPS), *cols)
    assert want and want != free  # elements did expire
    got = ST.zip_stream(stamped(spark, df), "workpiece", STEPS, 6000, clock="clock_ms")
    assert sorted_rows(collected(spark, got), *cols) == want
    sizes = ["workpiece", "event_id", "n1", "n2", "n3", "n4"]
    got = ST.pending_sizes_stream(stamped(spark, df), "workpiece", STEPS, 6000, clock="clock_ms")
    assert sorted_rows(collected(spark, got), *sizes) == sorted_rows(
        Z.pending_sizes_write_ttl(clocked, "workpiece", routes, 6000), *sizes
    )


def test_stateful_streams_run_in_a_session_with_the_default_state_store(spark):
    old = spark.conf.get(replay.PROVIDER)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(replay.PROVIDER, default)
    try:
        rows = [(i, i, "wp", 1 + i % 2, 1000 + i, s) for i, s in enumerate(STEPS)]
        tuples = ST.zip_stream(stamped(spark, log(spark, rows)), "workpiece", STEPS, 9000, idle=True, clock="clock_ms")
        assert sorted_rows(collected(spark, tuples), "workpiece", "n_tuple", "trigger_event") == [("wp", 1, 3)]
        assert spark.conf.get(replay.PROVIDER) == default  # the caller's session has its own setting back
    finally:
        spark.conf.set(replay.PROVIDER, old)
    with pytest.raises(ValueError), replay.state_store(spark):
        raise ValueError
    assert spark.conf.get(replay.PROVIDER) == old


@pytest.mark.parametrize("name, batch", [
    ("stream_sorted_rows", "win_sorted_rows"),
    ("stream_refire_panes", "win_refire_panes"),
    ("stream_apply_udf", "win_apply_udf"),
    ("stream_zip_idle_ttl", "zip_join_idle_ttl"),
    ("stream_match_keyed", "seq_match_late_dropped"),
    ("stream_process_tracking", "process_tracking"),
    ("stream_process_tracking_keyed", "process_tracking"),
])
def test_stream_queries_run_in_a_session_with_the_default_state_store(spark, tmp_path, name, batch):
    events = spark.range(240).selectExpr(
        "id AS event_id", "timestamp_millis(1700000000000 + id * 600000 - (id % 7) * 900000) AS ts", "id DIV 4 % 3 AS user_id",
        "element_at(array('view', 'click', 'cart', 'purchase', 'signup'), cast(1 + id % 5 AS int)) AS event_type",
        "cast(id % 11 AS double) AS value", "cast(NULL AS string) AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    old = spark.conf.get(replay.PROVIDER)
    spark.conf.unset(replay.PROVIDER)
    try:
        got = Q.QUERIES[name](spark, str(tmp_path))
        want = Q.QUERIES[batch](spark, str(tmp_path))
        assert got.columns == want.columns and want.count() > 0
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    finally:
        spark.conf.set(replay.PROVIDER, old)


@pytest.mark.parametrize("ttl_ms, n", [(2000, 0), (600_000, 1)])
def test_a_gap_in_processing_time_expires_a_running_stream(spark, ttl_ms, n):
    """Two runs of one query with a pause between: its lists are empty after a longer one than the TTL."""
    source, checkpoint, out = (tempfile.mkdtemp(prefix=f"tm-{x}-") for x in ("in", "ck", "out"))
    for part, steps in enumerate([STEPS[:3], STEPS[3:]]):
        rows = [(10 * part + i, 10 * part + i, "wp", 1, 1000 + i, s) for i, s in enumerate(steps)]
        replay.write_ordered(log(spark, rows), "seq", f"{source}/{part}", 1)
        stream = replay.read_ordered(spark, source, LOG)
        tuples = ST.zip_stream(stream, "workpiece", STEPS, ttl_ms, idle=True)
        query = tuples.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        # a query with timers in processing time runs batches for ever: wait for the one with rows
        query = query.trigger(processingTime="0 seconds").start()
        until = time.time() + 60
        while query.isActive and time.time() < until and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.2)
        query.stop()
        assert query.exception() is None
        time.sleep(3)
    assert spark.read.schema("n_tuple long").parquet(out).count() == n


def test_an_event_reads_few_of_a_hundred_thousand_waiting_elements():
    handle = Counted()
    zipper = ST.FifoZipProcessor(STEPS, "")
    zipper.init(handle)
    row = lambda i, c: Row(seq=i, event_id=i, time_stamp=i, content=c)
    waiting = [row(i, STEPS[i % 3]) for i in range(100_000)]
    assert list(zipper.handleInputRows(("k",), iter(waiting), Times())) == []
    assert len(handle.maps["items"]) == 100_000
    handle.reads = handle.writes = 0
    (hit,) = zipper.handleInputRows(("k",), iter([row(200_000, STEPS[3])]), Times())
    assert (hit["step1_event"], hit["step4_event"], hit["n_tuple"]) == (0, 200_000, 1)
    assert handle.reads <= 5 and handle.writes <= 4
    handle.reads = 0
    assert list(zipper.handleInputRows(("k",), iter([row(200_001, None), row(200_002, "error")]), Times())) == []
    assert handle.reads == 0


# ---------------------------------------------------------------- patterns
def test_a_hundred_thousand_partials_advance_in_constant_time():
    handle = Counted()
    fold = SP.SequenceMatchProcessor(["a", "b", "c"], ["seq"], ["id"], ["long"])
    fold.init(handle)

    def at(ts, items):
        list(fold.handleInputRows(("k",), iter([Row(ts=ts, mask=m, o0=q, p0=q) for q, m in items]), Times()))
        return fold.handleExpiredTimer(("k",), Times(ts), Times(ts))

    assert list(at(1, [(i, 1) for i in range(100_000)])) == []
    for ts, mask in ((2, 2), (3, 2), (4, 0), (5, 1)):
        handle.reads = handle.writes = 0
        assert list(at(ts, [(200_000 + ts, mask)])) == []
        assert handle.reads <= 2 and handle.writes <= 4
    done = list(at(6, [(300_000, 4)]))
    assert len(done) == 100_000  # the start at 5 waits for its own second step
    assert {r["s1_0"] for r in done} == {200_002} and sorted(r["s0_0"] for r in done) == list(range(100_000))
    assert len(handle.maps["nodes"]) == 1 and not handle.maps["buffer"]


def test_a_timer_reads_only_what_is_due():
    handle = Counted()
    fold = SP.SequenceMatchProcessor(["a", "b"], ["seq"], ["id"], ["long"])
    fold.init(handle)
    list(fold.handleInputRows(("k",), iter([Row(ts=t, mask=1, o0=t, p0=t) for t in range(10_000)]), Times()))
    assert handle.timers == list(range(10_000))
    handle.reads = 0
    list(fold.handleExpiredTimer(("k",), Times(0), Times(0)))
    assert handle.reads == 1 and len(handle.maps["buffer"]) == 9_999


def pattern():
    return J.step_pattern(STEPS)


def test_keyed_pattern_with_ties_equals_batch(spark):
    rows = [(*r[:4], r[4] // 2000 * 2000, r[5]) for r in log_rows(500, 7, keys=3)]
    df = log(spark, rows)
    kept = C.drop_late(stamped_batch(df))
    cols = [f"{s}_event_id" for s in STEPS]
    want = sorted_rows(C.match_sequence(kept, pattern(), partition_by=["workpiece"]), *cols)
    stream = SP.match_stream(C.drop_late(stamped(spark, df)), pattern(), "workpiece", payload=["time_stamp", "event_id"])
    assert want and sorted_rows(collected(spark, stream), *cols) == want


def test_pattern_without_a_key_equals_batch(spark, monkeypatch):
    """Open starts are carried over batches; also with every range cut into small buckets."""
    from tidemark.plans import scan as scan_mod

    df = log(spark, [(*r[:4], r[4] // 1000 * 1000, r[5]) for r in log_rows(400, 11, noise=0.7)])
    cols = [f"{s}_event_id" for s in STEPS]
    want = sorted_rows(C.match_sequence(C.drop_late(stamped_batch(df)), pattern()), *cols)
    for small in (False, True):
        if small:
            monkeypatch.setattr(scan_mod, "MIN_BUCKET_ROWS", 16)
        got = matched(spark, stamped(spark, df), pattern(), ["time_stamp", "seq"], ["event_id"], "wm_ms", "after_ms")
        assert want and sorted_rows(got, *cols) == want


def test_pattern_batches_may_run_again(spark):
    """Groups of many batches, a batch run twice, an empty one; open starts are read when they complete."""
    rows = [(i, i, "wp", 1, i, c) for i, c in enumerate(
        ["step1", "step2", "step1", "x", "step1", "step3", "step2", "step4", "step1", "step3", "step4", "step2", "step3"])]
    df = log(spark, rows).withColumns({"wm_ms": F.lit(None).cast("long"), "after_ms": F.col("seq")})
    fold = GlobalPattern(tempfile.mkdtemp(prefix="tm-gp-"), pattern(), df.schema, ["time_stamp", "seq"], ["event_id"])
    parts = [df.where(F.col("seq").isin(*x)) for x in ([0, 1, 2], [3], [4, 5, 6], [], [7, 8, 9], [10, 11, 12])]
    for k, part in enumerate(parts):
        fold(part, k)
        if k in (2, 4):
            fold(part, k)
    assert fold.last_batch(spark) == 5
    fold.end(spark, 5)
    got = sorted_rows(fold.matches(spark), *[f"{s}_event_id" for s in STEPS])
    assert got == sorted_rows(C.match_sequence(df, pattern()), *[f"{s}_event_id" for s in STEPS])
    assert got == [(0, 1, 5, 7), (2, 6, 9, 10), (4, 6, 9, 10)]


# ---------------------------------------------------------------- windows
def test_windows_fire_and_refire_like_the_batch(spark):
    rows = [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in log_rows(500, 13)]
    df = log(spark, rows).withColumn("temperature", F.when(F.col("event_id") % 9 != 0, F.col("event_id") * 0.5))
    batch = stamp_watermark(df, SPEC, ts="time_stamp")
    stream = lambda: stamped_replay(spark, df, SPEC)
    labelled = W.label_lateness(batch, 5000, 2000, ts="time_stamp")
    cols = ["workpiece", "window_start", "pane", "fired_by", "n_rows", "sum_value", "min_value", "max_value"]
    key = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    want = key(W.refire_panes(labelled, "workpiece", "temperature").select(*cols).collect())
    got = SW.refire_panes_stream(stream(), "workpiece", "temperature", 5000, 2000)
    assert key(collected(spark, got).select(*cols).collect()) == want
    late = collected(spark, SW.late_rows_stream(stream(), 5000, 2000))
    assert sorted_rows(late, "event_id") == sorted_rows(W.late_side_output(labelled), "event_id") != []
    on_time = W.emitted_rows(W.label_lateness(batch, 5000, 0, ts="time_stamp"))
    cols = ["workpiece", "window_start", "pos", "event_id"]
    want = sorted_rows(W.sorted_window_rows(on_time, "workpiece", ts="time_stamp"), *cols)
    for slices in (1, 8):
        got = SW.sorted_rows_stream(stream(), "workpiece", 5000, slices=slices)
        assert sorted_rows(collected(spark, got), *cols) == want
