"""NULL keys, keys beyond 2^53, functions without output, Java parsing, scratch folders."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.parse import QUARANTINE, parse_log_lines, parse_sensor_lines
from tidemark.operators.windows import apply_window_function
from tidemark.operators.zipjoin import zip_join_write_ttl

BIG = 9007199254740993


def test_write_ttl_zip_keeps_null_and_big_keys(spark):
    rows = []
    for key in (None, BIG):
        for i, step in enumerate(("a", "b")):
            rows.append((key, len(rows), 1000 + i, 1000 + i, len(rows), step))
    df = spark.createDataFrame(rows, "k long, seq long, clock_ms long, time_stamp long, event_id long, step string")
    routes = {s: F.col("step") == s for s in ("a", "b")}
    got = zip_join_write_ttl(df, "k", routes, 10_000).collect()
    assert {r["k"] for r in got} == {None, BIG} and len(got) == 2


@pytest.mark.parametrize("kind", ["long", "string"])
def test_windows_of_null_keys_stay_whole(spark, kind):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(None if i < 8 else BIG, 0, i) for i in range(10)], "k long, window_start long, v long")
        df = df.withColumn("k", F.col("k").cast(kind))
        fn = lambda pdf: {"k": pdf["k"].iloc[0], "n": len(pdf)}
        got = {r["k"]: r["n"] for r in apply_window_function(df, "k", fn, f"k {kind}, n long").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {None: 8, BIG if kind == "long" else str(BIG): 2}


def test_window_function_may_emit_nothing(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 10, 6)], "k long, window_start long, v long")
    assert apply_window_function(df, "k", lambda pdf: [], "k long, n long").count() == 0
    assert apply_window_function(df, "k", lambda pdf: pd.DataFrame(columns=["k", "n"]), "k long, n long").count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_window_function_over_arrays_sees_the_same_windows(spark, kind):
    rows = [(None if i % 3 == 0 else BIG, 10 * (i % 2), i) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, window_start long, v long").withColumn("k", F.col("k").cast(kind)).repartition(3)
    fn = lambda w: {"k": None if pd.isna(k := list(w["k"])[0]) else k, "n": len(w["v"]), "v": int(sum(w["v"]))}
    schema = f"k {kind}, n long, v long"
    got = apply_window_function(df, "k", lambda w: fn(w) if isinstance(w, dict) else None, schema, arrays=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, apply_window_function(df, "k", fn, schema).collect()))
    assert got.count() == 4


def test_trailing_empty_fields_are_missing(spark):
    lines = spark.createDataFrame([("ws, wp1, 1000,",), ("ws, wp1, 1000, x",), ("ws, wp1, 1000, ,",)], "value string")
    rows, bad = parse_log_lines(lines, mode=QUARANTINE)
    assert rows.count() == 2 and bad.count() == 1


@pytest.mark.parametrize(
    "text, value",
    [("1.5", 1.5), ("2e3", 2000.0), (".5f", 0.5), ("inf", None), ("nan", None), ("Infinity", float("inf")), ("infinity", None)],
)
def test_doubles_as_java_reads_them(spark, text, value):
    rows, bad = parse_sensor_lines(spark.createDataFrame([(f"s1, 1000, {text}",)], "value string"), mode=QUARANTINE)
    got = [r["temperature"] for r in rows.collect()]
    assert got == ([] if value is None else [value])


def test_scratch_folder_must_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
