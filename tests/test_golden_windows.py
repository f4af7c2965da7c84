"""Window, watermark and lateness jobs on the sample sensor blocks (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.operators import windows as W
from tidemark.plans.watermark import bounded_out_of_orderness, monotonous, periodic_generator

from fixtures import B1, B2, BASE, sensor_block

S = 1000


def _emitted(df):
    """{window start second: [(second, temp) in arrival order]} of re-emitted rows."""
    out = {}
    for r in W.emitted_rows(df).orderBy("seq").collect():
        out.setdefault((r["window_start"] - BASE) // S, []).append(((r["time_stamp"] - BASE) // S, int(r["temperature"])))
    return out


def _dropped(df):
    return [((r["time_stamp"] - BASE) // S, int(r["temperature"])) for r in W.late_side_output(df).orderBy("seq").collect()]


CASES = [
    ("monotonous", B1, {0: [(0, 2)], 5: [(5, 9)], 10: [(10, 3)], 15: [(15, 11)], 20: [(20, 7)]},
     [(2, 10), (4, 9), (5, 8), (4, 11)]),
    ("monotonous", B2, {10: [(10, 3)], 20: [(20, 8)]}, [(4, 9), (5, 8), (3, 7)]),
    ("bounded", B1, {0: [(0, 2)], 5: [(5, 9), (5, 8)], 10: [(10, 3)], 15: [(15, 11)], 20: [(20, 7)]},
     [(2, 10), (4, 9), (4, 11)]),
    ("bounded", B2, {5: [(5, 8)], 10: [(10, 3)], 20: [(20, 8)]}, [(4, 9), (3, 7)]),
    ("custom", B1, {0: [(0, 2)], 5: [(5, 9), (5, 8)], 10: [(10, 3)], 15: [(15, 11)], 20: [(20, 7)]},
     [(2, 10), (4, 9), (4, 11)]),
    ("custom", B2, {5: [(5, 8)], 10: [(10, 3)], 20: [(20, 8)]}, [(4, 9), (3, 7)]),
]
SPECS = {"monotonous": monotonous(), "bounded": bounded_out_of_orderness(5 * S), "custom": periodic_generator(3 * S)}


@pytest.mark.parametrize("kind,block,emitted,dropped", CASES)
def test_window_jobs(spark, kind, block, emitted, dropped):
    lab = J.window_job(sensor_block(spark, block), SPECS[kind], 5 * S)
    assert _emitted(lab) == emitted
    assert _dropped(lab) == dropped


def _panes(spark, block):
    lab = J.window_job(sensor_block(spark, block), bounded_out_of_orderness(5 * S), 5 * S, 1 * S)
    panes = W.refire_panes(lab, "id", "temperature")
    return {((r["window_start"] - BASE) // S, r["pane"]): (r["n_rows"], r["sum_value"]) for r in panes.collect()}, lab


def test_lateness_refires_block1(spark):
    panes, lab = _panes(spark, B1)
    # [0,5): (0,2); re-fire +(2,10); re-fire +(4,9)
    assert panes[(0, 0)] == (1, 2.0) and panes[(0, 1)] == (2, 12.0) and panes[(0, 2)] == (3, 21.0)
    assert panes[(5, 0)] == (2, 17.0) and panes[(10, 0)] == (1, 3.0)
    assert panes[(15, 0)] == (1, 11.0) and panes[(20, 0)] == (1, 7.0)
    assert len(panes) == 7
    assert _dropped(lab) == [(4, 11)]


def test_lateness_refires_block2_without_first_pane(spark):
    panes, lab = _panes(spark, B2)
    assert (0, 0) not in panes  # no on-time row: the first late row fires the window
    assert panes[(0, 1)] == (1, 9.0) and panes[(0, 2)] == (2, 16.0)
    assert panes[(5, 0)] == (1, 8.0) and panes[(10, 0)] == (1, 3.0) and panes[(20, 0)] == (1, 8.0)
    assert _dropped(lab) == []


@pytest.mark.parametrize(
    "block,expected",
    [
        (B1, {0: [(0, 2), (2, 10), (4, 9), (4, 11), (5, 9), (5, 8)], 10: [(10, 3), (15, 11)], 20: [(20, 7)]}),
        (B2, {0: [(3, 7), (4, 9), (5, 8)], 10: [(10, 3)], 20: [(20, 8)]}),
    ],
)
def test_sorted_windows(spark, block, expected):
    lab = J.window_job(sensor_block(spark, block), bounded_out_of_orderness(10 * S), 10 * S)
    rows = W.sorted_window_rows(W.emitted_rows(lab), "id", ts="time_stamp").collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["window_start"], r["pos"])):
        got.setdefault((r["window_start"] - BASE) // S, []).append(((r["time_stamp"] - BASE) // S, int(r["temperature"])))
    assert got == expected


def test_window_udf_sees_whole_windows(spark):
    import pandas as pd

    lab = J.window_job(sensor_block(spark, B1), bounded_out_of_orderness(5 * S), 5 * S)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"window_start": [int(pdf["window_start"].iloc[0])], "n": [len(pdf)]})

    out = W.apply_window_function(W.emitted_rows(lab), "id", fn, "window_start bigint, n bigint")
    got = {(r["window_start"] - BASE) // S: r["n"] for r in out.collect()}
    assert got == {0: 1, 5: 2, 10: 1, 15: 1, 20: 1}


def test_labels_partition_the_input(spark):
    lab = J.window_job(sensor_block(spark, B1 + B2), bounded_out_of_orderness(5 * S), 5 * S, 1 * S)
    counts = {r["label"]: r["n"] for r in lab.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == len(B1 + B2)


def test_window_function_over_an_iterator_of_rows(spark):
    """A hot window, a NULL key, a long key and a window without output; batches of 50 rows."""
    big = 2**53 + 1
    rows = [(big, 1, i, 1000 - i) for i in range(900)] + [(None, 1, 2000 + i, i) for i in range(3)] + [(big + 1, 1, 3000, 5), (7, 2, 9, 9)]
    df = spark.createDataFrame([(k, w * 10, w * 10 + 10, s, t) for k, w, s, t in rows],
                               "k long, window_start long, window_end long, seq long, time_stamp long").repartition(4)

    def fn(key, start, end, rows):
        if key == 7:
            return
        n, last, ordered = 0, None, True
        for r in rows:
            ordered = ordered and (last is None or last <= (r["time_stamp"], r["seq"]))
            n, last = n + 1, (r["time_stamp"], r["seq"])
        yield key, start, end, n, ordered

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        out = W.apply_window_rows(df, "k", fn, "k long, s long, e long, n long, ok boolean", [])
        got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {big: (10, 20, 900, True), None: (10, 20, 3, True), big + 1: (10, 20, 1, True)}
    first = W.apply_window_rows(df, "k", lambda k, s, e, rows: [(next(iter(rows))["seq"],)], "seq long", [])
    assert sorted(r["seq"] for r in first.collect()) == [9, 899, 2000, 3000]
    assert W.apply_window_rows(df.limit(0), "k", fn, "k long, s long, e long, n long, ok boolean", []).count() == 0
