"""Many keys to a row of state: few calls, pages that double, large lists and maps apart, the same results."""

import pickle

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.operators import sequence as C
from tidemark.operators import windows as W
from tidemark.operators import zipjoin as Z
from tidemark.plans.watermark import stamp_watermark
from tidemark.stream_queries import collected, stamped_replay
from tidemark.streaming import pattern as SP
from tidemark.streaming import shared
from tidemark.streaming import stateful as ST
from tidemark.streaming import windows as SW

from fixtures import STEPS
from test_stream_state import SPEC, Times, few_partitions, log, log_rows, pattern, sorted_rows, stamped, stamped_batch  # noqa: F401


class Store:
    """The state of one share, its calls counted."""

    def __init__(self):
        self.calls, self.kept, self.timers = 0, {}, set()

    def getMapState(self, name, *_):
        outer, items = self, self.kept.setdefault(name, {})

        class Map:
            def getValue(self, key):
                outer.calls += 1
                return items.get(key)

            def containsKey(self, key):
                outer.calls += 1
                return key in items

            def updateValue(self, key, value):
                outer.calls += 1
                items[key] = value

            def removeKey(self, key):
                outer.calls += 1
                items.pop(key, None)

            def keys(self):
                outer.calls += 1
                return iter(list(items))

        return Map()

    def getValueState(self, name, *_):
        outer, kept = self, self.kept

        class Value:
            def exists(self):
                outer.calls += 1
                return name in kept

            def get(self):
                outer.calls += 1
                return kept.get(name)

            def update(self, value):
                outer.calls += 1
                kept[name] = value

        return Value()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


def fired(processor, store, now):
    """What Spark does when the watermark is ``now``: due timers run, then are deleted."""
    out = []
    for at in sorted(t for t in store.timers if t < now):
        out += processor.handleExpiredTimer((0,), Times(now), Times(at))
        store.timers.discard(at)
    return out


def spread(key, start, end, rows):
    yield key, start, sum(1 for _ in rows)


PROCESSORS = {
    "windows": lambda: (SW.WindowProcessor(spread, ["id", "start", "n"], ["v", "ts", "seq"], "", "ts", "seq", 10), ["id", "start"]),
    "panes": lambda: (SW.PaneProcessor("id", 10, 5, "v", "seq", "seq"), ["id", "start"]),
    "pattern": lambda: (SP.SequenceMatchProcessor(["a", "b"], ["seq"], ["id"], ["long"]), ["id"]),
    "zip": lambda: (ST.FifoZipProcessor(["s1", "s2"], "", 10, idle=True, clock="ts", ts="ts", row_id="seq"), ["id"]),
}


@pytest.mark.parametrize("kind", sorted(PROCESSORS))
def test_state_is_read_and_written_per_share_not_per_key(kind):
    inner, keys = PROCESSORS[kind]()
    processor, store = shared.EventTimeShared(inner, keys), Store()
    processor.init(store)
    rows = [
        Row(id=i % 2000, start=0, ts=i // 2000, seq=i, v=1.0, label="on_time", content=f"s{1 + i // 2000}",
            mask=1 + i // 2000, o0=i, p0=i)
        for i in range(4000)
    ]
    out = list(processor.handleInputRows((0,), iter(rows), Times(0)))
    assert store.timers and len(store.timers) == 1
    out += fired(processor, store, 100)
    assert len(out) == 2000 and store.calls < 60  # one result per key
    out = fired(processor, store, 10_000)
    assert out == [] and not store.timers


def test_pages_double_and_keys_leave_them_when_their_state_is_gone():
    inner, keys = PROCESSORS["panes"]()
    processor, store = shared.EventTimeShared(inner, keys), Store()
    processor.init(store)
    processor.page_bytes = 2000
    for part in range(20):
        rows = [Row(id=i, start=0, seq=i, v=1.0, label="on_time") for i in range(100 * part, 100 * part + 100)]
        assert list(processor.handleInputRows((0,), iter(rows), Times(0))) == []
    pages = [pickle.loads(v[0]) for v in store.kept["pages"].values()]
    assert len(pages) > 4 and sorted(k[0] for p in pages for k in p) == list(range(2000))
    assert sorted(r["id"] for r in fired(processor, store, 11)) == list(range(2000))
    assert fired(processor, store, 1000) == [] and not store.kept["pages"] and not store.timers


def test_large_lists_and_maps_of_a_key_lie_entry_by_entry():
    processor, store = shared.EventTimeShared(SP.SequenceMatchProcessor(["a", "b"], ["o"], ["p"], ["long"]), ["key"]), Store()
    processor.init(store)
    processor.far_items = 10
    row = lambda ts, mask: Row(key="k", ts=ts, mask=mask, o0=ts, p0=ts)
    assert list(processor.handleInputRows((0,), (row(t, 1) for t in range(1, 1001)), Times(0))) == []
    assert len(store.kept["far"]) == 1000 and len(store.kept["pages"][(0,)][0]) < 10_000
    assert fired(processor, store, 1001) == []
    assert len(store.kept["far"]) == 1000  # the buffer is empty, the partial matches wait
    calls = store.calls
    assert list(processor.handleInputRows((0,), iter([row(2000, 0)]), Times(1001))) == []
    assert fired(processor, store, 2001) == [] and store.calls - calls < 30
    assert list(processor.handleInputRows((0,), iter([row(3000, 2)]), Times(2001))) == []
    assert sorted(r["s0_0"] for r in fired(processor, store, 3001)) == list(range(1, 1001))
    assert not store.kept["far"]


@pytest.fixture(params=["default", "tiny"])
def bounds(request, monkeypatch):
    """As planned, and with one share whose pages double and whose lists and maps lie apart at once."""
    if request.param == "tiny":
        for name, value in {"SHARES": 1, "PAGE_BYTES": 300, "FAR_ITEMS": 2}.items():
            monkeypatch.setattr(shared, name, value)
    return request.param


def test_streams_with_keys_that_are_null_equal_the_batch(spark, bounds):
    rows = [(*r[:2], r[2] if r[2] != "wp1" else None, *r[3:]) for r in log_rows(250, 17, keys=6)]
    df = log(spark, rows).withColumn("temperature", F.when(F.col("event_id") % 9 != 0, F.col("event_id") * 0.5))
    text = lambda df, *cols: sorted(tuple(str(x) for x in r) for r in df.select(*cols).collect())
    # windows and panes
    batch, stream = stamp_watermark(df, SPEC, ts="time_stamp"), stamped_replay(spark, df, SPEC)
    cols = ["workpiece", "window_start", "pos", "event_id"]
    want = W.sorted_window_rows(W.emitted_rows(W.label_lateness(batch, 5000, 0, ts="time_stamp")), "workpiece", ts="time_stamp")
    assert text(collected(spark, SW.sorted_rows_stream(stream, "workpiece", 5000)), *cols) == text(want, *cols)
    cols = ["workpiece", "window_start", "pane", "fired_by", "n_rows", "sum_value", "min_value", "max_value"]
    want = W.refire_panes(W.label_lateness(batch, 5000, 2000, ts="time_stamp"), "workpiece", "temperature")
    assert text(collected(spark, SW.refire_panes_stream(stream, "workpiece", "temperature", 5000, 2000)), *cols) == text(want, *cols)
    # zip and pattern
    batch, stream = stamped_batch(df), stamped(spark, df)
    cols = ["workpiece", "session", "n_tuple", "trigger_event", *[f"{s}_event" for s in STEPS]]
    sessions = Z.route_steps(Z.gap_sessions(batch, "workpiece", 9000), Z.contains_routes(STEPS))
    want = Z.zip_join(sessions, "workpiece", STEPS, group=["session"])
    got = ST.zip_stream(stream, "workpiece", STEPS, 9000, idle=True, clock="clock_ms", keep_sessions=True)
    assert text(collected(spark, got), *cols) == text(want, *cols)
    cols = [f"{s}_event_id" for s in STEPS]
    want = sorted_rows(C.match_sequence(C.drop_late(batch), pattern(), partition_by=["workpiece"]), *cols)
    got = SP.match_stream(C.drop_late(stream), pattern(), "workpiece", payload=["time_stamp", "event_id"])
    assert want and sorted_rows(collected(spark, got), *cols) == want


def test_values_travel_exactly(spark):
    """Integers above 2**53 beside NULL, NaN that is not NULL, texts that are empty or NULL."""
    values = [float("nan"), None, -0.0, 1.5, float("inf")]
    rows = [
        (i, 2**62 + i if i % 4 else None, [None, "", "a"][i % 3], 1_000_000 + 10 * i, values[i % 5], 2**60 + i if i % 2 else None)
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "seq long, event_id long, id string, time_stamp long, temperature double, more long")
    stream = SW.sorted_rows_stream(stamped_replay(spark, df, SPEC), "id", 10_000)
    got = collected(spark, stream).select("event_id", "id", "time_stamp", "temperature").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[1], r[2], r[3], r[4])) for r in rows)
    assert shared._plain(df.schema) and not shared._plain(df.withColumn("x", F.array("seq")).schema)


def test_columns_that_frames_do_not_hold_travel_as_rows(spark):
    df = spark.createDataFrame(
        [(i, i, "wp", 1, 1000 + i, s) for i, s in enumerate(STEPS)], "seq long, event_id long, workpiece string, station int, time_stamp long, content string"
    ).withColumn("event_id", F.array("event_id"))
    tuples = ST.zip_stream(stamped(spark, df), "workpiece", STEPS, 9000, idle=True, clock="clock_ms")
    assert [tuple(r) for r in collected(spark, tuples).select("workpiece", "n_tuple", "trigger_event").collect()] == [("wp", 1, [3])]
