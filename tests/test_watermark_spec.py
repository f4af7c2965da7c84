"""Watermark strategies and their streaming equivalents."""

from pyspark.sql import functions as F

from tidemark.plans.watermark import (
    bounded_out_of_orderness,
    epoch_ms,
    monotonous,
    periodic_generator,
    stamp_watermark,
)
from tidemark.streaming.windows import flush_sentinel_ms


def test_lags_and_streaming_delays():
    assert bounded_out_of_orderness(5000).lag_ms == 5001
    assert monotonous().lag_ms == 1
    assert periodic_generator(3000).lag_ms == 3000
    # Spark closes [s, e) when max - delay >= e, i.e. max - lag >= e - 1
    assert bounded_out_of_orderness(5000).streaming_delay == "5000 milliseconds"
    assert periodic_generator(3000).streaming_delay == "2999 milliseconds"


def test_flush_sentinel_closes_last_window():
    spec = bounded_out_of_orderness(5000)
    t = flush_sentinel_ms(20_000, spec, 5000)
    last_end = 25_000
    assert t - spec.lag_ms >= last_end - 1


def test_first_row_has_no_watermark_and_union_waits_for_both(spark):
    rows = [(1, 1, 100), (2, 1, 200), (3, 2, 50), (4, 1, 300)]
    df = spark.createDataFrame(rows, "seq long, station int, ts long")
    one = {r["seq"]: r["wm_ms"] for r in stamp_watermark(df, monotonous(), ts="ts").collect()}
    assert one == {1: None, 2: 99, 3: 199, 4: 199}
    both = stamp_watermark(df, monotonous(), ts="ts", stream="station", streams=[1, 2], clock="clock")
    got = {r["seq"]: (r["wm_ms"], r["clock"]) for r in both.collect()}
    assert got == {1: (None, 100), 2: (None, 200), 3: (None, 200), 4: (49, 300)}


def test_epoch_ms_is_zone_independent(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t")
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert df.select(epoch_ms("t").alias("m")).first()["m"] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
