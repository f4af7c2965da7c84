"""Line parsing modes, rendering and small sources."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import render as R
from tidemark.functions.parse import FAILFAST, QUARANTINE, java_trim, parse_log_lines, parse_sensor_lines
from tidemark.sources import lines as S

SAMPLE = ["sensor1,1000000000000,2", "sensor1,1000000005000,9", "", "", "sensor1,1000000010000,3"]


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq long, value string")


def test_quarantine_returns_blank_lines(spark):
    rows, bad = parse_sensor_lines(_lines(spark, SAMPLE), mode=QUARANTINE)
    assert rows.count() == 3 and bad.count() == 2
    assert sorted(r["seq"] for r in bad.collect()) == [2, 3]
    assert rows.schema["time_stamp"].dataType.simpleString() == "bigint"
    assert rows.schema["temperature"].dataType.simpleString() == "double"


def test_failfast_raises_on_blank_line(spark):
    rows, bad = parse_sensor_lines(_lines(spark, SAMPLE), mode=FAILFAST)
    assert bad is None
    with pytest.raises(Exception, match="malformed line"):
        rows.collect()


def test_java_style_parse(spark):
    values = [" sensor1 ,\t1000 , 2.5 ", "s,1.5,2", "s,+7,1e2,extra", "s,12", "s,x,1"]
    rows, bad = parse_sensor_lines(_lines(spark, values), mode=QUARANTINE)
    got = {r["seq"]: (r["id"], r["time_stamp"], r["temperature"]) for r in rows.collect()}
    assert got == {0: ("sensor1", 1000, 2.5), 2: ("s", 7, 100.0)}
    assert sorted(r["seq"] for r in bad.collect()) == [1, 3, 4]


def test_log_line_parse_trims_blanks(spark):
    rows, _ = parse_log_lines(_lines(spark, ["workStation_1, wp1, 1000000003000, step3"]))
    r = rows.first()
    assert (r["id"], r["workpiece"], r["time_stamp"], r["content"]) == ("workStation_1", "wp1", 1000000003000, "step3")


def test_java_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\x01 a b\x1f\n",)], "v string")
    assert df.select(java_trim(F.col("v")).alias("t")).first()["t"] == "a b"


def test_render_formats(spark):
    df = spark.createDataFrame([("sensor1", 1000000000000, 2.0)], "id string, time_stamp long, temperature double")
    line = df.select(R.labelled(R.render_sensor(), "later data").alias("l")).first()["l"]
    assert line == "later data> SensorReading{id='sensor1', timeStamp=1000000000000, temperature=2.0}"
    log = spark.createDataFrame([("w", "wp1", 5, "step1")], "id string, workpiece string, time_stamp long, content string")
    assert log.select(R.render_log_event().alias("l")).first()["l"] == (
        "LogEvent{id='w', workpiece='wp1', timeStamp=5, content='step1'}"
    )
    pd_ = spark.createDataFrame([(1, 2, 3, 4)], "step1_ts long, step2_ts long, step3_ts long, step4_ts long")
    assert pd_.select(R.render_process_data(["step1", "step2", "step3", "step4"]).alias("l")).first()["l"] == (
        "ProcessData{step1=(step1,1), step2=(step2,2), step3=(step3,3), step4=(step4,4)}"
    )


def test_collection_source_and_first_field(spark):
    pairs = S.from_collection(spark, [("java", 1), ("C++", 2)])
    assert [r["_1"] for r in S.first_field(pairs).collect()] == ["java", "C++"]


def test_kafka_and_socket_options_are_plain_config(spark):
    opts = S.kafka_options("topic1", "broker:9092")
    assert opts["subscribe"] == "topic1" and opts["kafka.bootstrap.servers"] == "broker:9092"
    reader = S.socket_reader(spark, "localhost", 7777)  # no connection until a query starts
    assert reader is not None
