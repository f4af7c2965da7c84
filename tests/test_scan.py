"""The bucketed scan equals a brute-force sequential scan, also with a hot key."""

import random
from operator import add, xor

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.plans.scan import row_number, scan


def _data(n=3000, keys=5, hot=True, seed=7):
    rng = random.Random(seed)
    seqs = rng.sample(range(0, 50 * n), n)  # unique, sparse
    rows = []
    for i, s in enumerate(seqs):
        k = "hot" if hot and i % 3 == 0 else f"k{rng.randrange(keys)}"
        rows.append((k, s, rng.randint(-50, 50)))
    return rows


def _brute(rows, keyed, following, inclusive, fn):
    df = pd.DataFrame(rows, columns=["k", "seq", "v"]).sort_values("seq", ascending=not following)
    out = {}
    groups = df.groupby("k") if keyed else [(None, df)]
    for _, g in groups:
        acc = None
        for s, v in zip(g["seq"], g["v"]):
            before = acc
            acc = v if acc is None else {"min": min, "max": max, "sum": add, "xor": xor}[fn](acc, v)
            res = acc if inclusive else before
            if fn in ("sum", "xor") and res is None:
                res = 0
            out[s] = res
    return out


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("fn", ["min", "max", "sum", "xor"])
def test_scan_matches_brute_force(spark, keyed, following, inclusive, fn):
    rows = _data()
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    # tiny buckets force the two-phase path and two levels of recursion
    got = scan(df, ["seq"], {"out": (fn, F.col("v"))}, partition_by=["k"] if keyed else [],
               following=following, inclusive=inclusive, bucket_rows=16)
    res = {r["seq"]: r["out"] for r in got.collect()}
    assert len(res) == len(rows)
    assert res == _brute(rows, keyed, following, inclusive, fn)


def test_struct_min_finds_next_matching_row(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "x"), ("a", 4, "y"), ("b", 5, "y")]
    df = spark.createDataFrame(rows, "k string, seq long, c string")
    nxt = F.when(F.col("c") == "y", F.struct("seq"))
    got = scan(df, ["seq"], {"n": ("min", nxt)}, partition_by=["k"], following=True, bucket_rows=2)
    res = {r["seq"]: (r["n"]["seq"] if r["n"] else None) for r in got.collect()}
    assert res == {1: 2, 2: 4, 3: 4, 4: None, 5: None}


def test_row_number_with_null_key_and_composite_order(spark):
    rows = [(None, 10, 2), (None, 10, 1), ("a", 5, 1), (None, 3, 9)]
    df = spark.createDataFrame(rows, "k string, ts long, seq long")
    got = row_number(df, "rn", ["ts", "seq"], partition_by=["k"], bucket_rows=2)
    res = sorted((r["k"], r["ts"], r["seq"], r["rn"]) for r in got.collect() if r["k"] is None)
    assert [x[3] for x in sorted(res, key=lambda x: (x[1], x[2]))] == [1, 2, 3]


def test_scan_is_independent_of_partitioning(spark):
    rows = _data(n=800, seed=3)
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    a = scan(df, ["seq"], {"o": ("max", F.col("v"))}, partition_by=["k"], bucket_rows=8)
    b = scan(df.repartition(13), ["seq"], {"o": ("max", F.col("v"))}, partition_by=["k"], bucket_rows=1000)
    assert sorted(a.collect()) == sorted(b.collect())


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("fn", ["min", "max", "sum", "xor"])
def test_chained_global_scans_sharing_a_bucket_column(spark, following, inclusive, fn):
    rows = _data(n=2000, seed=13)
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    a = scan(df, ["seq"], {"o1": (fn, F.col("v"))}, following=following, inclusive=inclusive,
             bucket_rows=16, bucket="__sb")
    assert "__sb" in a.columns
    b = scan(a, ["seq"], {"o2": (fn, F.col("v") * 2)}, following=following, inclusive=inclusive,
             bucket_rows=16, bucket="__sb")
    res = {r["seq"]: (r["o1"], r["o2"]) for r in b.collect()}
    brute = _brute(rows, False, following, inclusive, fn)
    brute2 = _brute([(k, s, 2 * v) for k, s, v in rows], False, following, inclusive, fn)
    assert res == {s: (brute[s], brute2[s]) for s in brute}
