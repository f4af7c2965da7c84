"""Outliers, bursts and hot keys: no window partition above its bound, and exact results."""

import pytest
from pyspark.sql import functions as F

from tidemark import jobs as J
from tidemark.operators import sequence as C
from tidemark.plans import scan as scan_mod
from tidemark.plans.scan import keyed_order_stats, order_stats, scan

BOUND = 2048


@pytest.fixture(autouse=True)
def small_bounds(monkeypatch):
    monkeypatch.setattr(scan_mod, "DIRECT_MAX_ROWS", BOUND)
    monkeypatch.setattr(scan_mod, "MIN_BUCKET_ROWS", 512)
    monkeypatch.setattr(scan_mod, "DEFAULT_BUCKET_ROWS", 1024)


def _lead(spark, kind):
    base = spark.range(20_000).select(F.col("id").alias("seq"))
    if kind == "outlier":
        far = spark.range(1).select(F.lit(10**15).alias("seq"))
    else:  # a dense burst inside a sparse order
        far = spark.range(200).select((F.col("id") * 1_000_000 + 50_000_000).alias("seq"))
    return base.union(far).withColumn("v", F.pmod(F.xxhash64("seq"), F.lit(10_000)))


def _window_partitions(monkeypatch):
    """Rows per (bucket) of every bucketed scan, recorded while plans are made."""
    seen = []
    plain = scan_mod._scan_staged

    def spy(df, order_by, vin, fns, keys, following, inclusive, bucket_rows, stats, depth=0, direct_rows=0):
        if depth == 0 and stats.n > max(bucket_rows, direct_rows):
            width = max(1, -(-(stats.hi - stats.lo + 1) * bucket_rows // stats.n))
            b = F.expr(f"(`{order_by[0]}` - {stats.lo}) div {width}")
            seen.append(df.groupBy(*keys, b.alias("b")).count().agg(F.max("count")).first()[0])
        return plain(df, order_by, vin, fns, keys, following, inclusive, bucket_rows, stats, depth, direct_rows)

    monkeypatch.setattr(scan_mod, "_scan_staged", spy)
    return seen


@pytest.mark.parametrize("kind", ["outlier", "burst"])
def test_one_column_orders_are_balanced(spark, monkeypatch, kind):
    seen = _window_partitions(monkeypatch)
    df = _lead(spark, kind)
    got = {r["seq"]: r["m"] for r in scan(df, ["seq"], {"m": ("max", "v")}).collect()}
    assert seen and max(seen) <= BOUND
    best, want = None, {}
    for r in sorted(df.collect(), key=lambda r: r["seq"]):
        want[r["seq"]] = best
        best = r["v"] if best is None else max(best, r["v"])
    assert got == want


def _keyed(spark):
    hot = spark.range(9_000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    none = spark.range(3_000).select(F.lit(None).cast("string").alias("k"), (F.col("id") * 3).alias("seq"))
    cold = spark.range(4_000).select(F.concat(F.lit("c"), F.col("id") % 800).alias("k"), (F.col("id") * 2).alias("seq"))
    return hot.union(none).union(cold)


def test_only_hot_keys_are_cut(spark, monkeypatch):
    df = _keyed(spark)
    stats = keyed_order_stats(df, ["seq"], ["k"])[1]["seq"]
    assert {r["k"] for r in stats.hot.collect()} == {"hot", None}
    tables = []
    plain = scan_mod._scan_staged

    def spy(df, *args, **kw):
        if len(args) > 8 and args[8] == 1:
            tables.append(df.groupBy("k").count().collect())
        return plain(df, *args, **kw)

    monkeypatch.setattr(scan_mod, "_scan_staged", spy)
    got = {(r["k"], r["seq"]): r["n"] for r in scan(df, ["seq"], {"n": ("sum", F.lit(1))}, ["k"], stats=stats).collect()}
    assert {r["k"] for r in tables[0]} == {"hot", None}
    assert sum(r["count"] for r in tables[0]) <= 2 * (stats.n // 512 + 2)
    want, count = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["seq"]):
        want[r["k"], r["seq"]] = count.get(r["k"], 0)
        count[r["k"]] = count.get(r["k"], 0) + 1
    assert got == want


def test_match_with_outlier_and_hot_key(spark):
    steps = F.element_at(F.array(*[F.lit(s) for s in ("step1", "step2", "step3", "step4", "error")]), (F.pmod(F.xxhash64("seq", "k"), F.lit(5)) + 1).cast("int"))
    rows = _keyed(spark).withColumn("event_id", F.xxhash64("seq", "k")).withColumn("content", steps)
    rows = rows.withColumn("seq", F.when((F.col("k") == "hot") & (F.col("seq") == 8_999), F.lit(10**14)).otherwise(F.col("seq")))
    pattern = J.step_pattern(("step1", "step2", "step3", "step4"))
    stats = keyed_order_stats(rows, ["seq"], ["k"])[1]["seq"]
    got = C.match_sequence(rows, pattern, ["seq"], ["k"], ["event_id"], stats)
    cols = got.columns
    plain = C.match_sequence(rows, pattern, ["seq"], ["k"], ["event_id"], scan_mod.OrderStats(0, 1, 1))
    assert got.count() > 1000
    assert sorted(map(repr, got.select(cols).collect())) == sorted(map(repr, plain.select(cols).collect()))


def test_stats_of_small_inputs_have_no_hot_keys(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("seq"))
    assert keyed_order_stats(df, ["seq"], ["k"])[1]["seq"].hot is None
    assert order_stats(df, "seq").n == 100
