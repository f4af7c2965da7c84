"""Every registered query equals its DuckDB oracle (sf0.001, all rows)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.compare import frames_match, register_views

SF = "/root/testdata/sf0.001"
# queries without SQL are held against golden cases or brute force in their own tests
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_views(c, SF)
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if name.startswith("stream_"):  # each batch opens a state store and a worker per partition
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ok, why = frames_match(got, con.sql(entry.oracle_sql()[name]).df())
    assert ok, why


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("stream_")])
def test_query_matches_oracle_on_bucketed_scans(spark, con, name, monkeypatch):
    """Same check with tiny scan bounds, so every scan takes the two-phase path."""
    from tidemark.plans import scan as scan_mod

    monkeypatch.setattr(scan_mod, "DIRECT_MAX_ROWS", 8)
    monkeypatch.setattr(scan_mod, "MIN_BUCKET_ROWS", 16)
    sql = entry.oracle_sql()[name]
    got = entry.queries()[name](spark, SF).toPandas()
    ok, why = frames_match(got, con.sql(sql).df())
    assert ok, why


@pytest.mark.parametrize("name", ["parse_sensor_lines", "win_bounded_agg", "sink_bucket_counts", "process_tracking"])
def test_results_do_not_depend_on_session_zone_or_partitions(spark, con, name):
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = entry.queries()[name](spark, SF).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    ok, why = frames_match(got, con.sql(entry.oracle_sql()[name]).df())
    assert ok, why
