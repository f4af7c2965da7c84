"""Paced line replay, Kafka values, collections, size rolling, co-group with a user function."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import batch as B
from tidemark.sources import lines as S
from tidemark.sources.replay import LineReader, LineReplay, replay_to_end
from tidemark.streaming import sinks as K


def folder(*texts):
    d = tempfile.mkdtemp(prefix="tm-lines-")
    for i, text in enumerate(texts):
        with open(os.path.join(d, f"{i:03d}.txt"), "wb") as f:
            f.write(text)
    open(os.path.join(d, "_SUCCESS"), "w").close()
    return d


FILES = (b"a1\na2\n\na4", b"", b"b1\n" + "é漢".encode() + b"\n", b"c" * 70_000 + b"\nend\n")
LINES = ["a1", "a2", "", "a4", "b1", "é漢", "c" * 70_000, "end"]


def test_reader_goes_on_from_any_offset():
    d = folder(*FILES)
    for most in (1, 2, 3, 100):
        reader, offset, got = LineReader(d, most), None, []
        offset = reader.initialOffset()
        while True:
            rows, end = LineReader(d, most).read(offset)  # a new reader, as after a restart
            rows = list(rows)
            assert list(reader.readBetweenOffsets(offset, end)) == rows and len(rows) <= most
            if not rows:
                assert end == offset  # the end stays the end
                break
            got, offset = got + rows, end
        assert got == [(v, i + 1) for i, v in enumerate(LINES)]
    with pytest.raises(ValueError):
        LineReader(d, 0)


def test_line_replay_in_order_stops_at_the_end_and_restarts_without_repeats(spark):
    spark.dataSource.register(LineReplay)
    d = folder(*FILES[:3])
    checkpoint = tempfile.mkdtemp(prefix="tm-ck-")
    batches = []

    def run():
        stream = spark.readStream.format("line_replay").option("path", f"file://{d}").option("lines_per_trigger", "2").load()
        writer = stream.writeStream.foreachBatch(lambda b, i: batches.append([tuple(r) for r in b.orderBy("seq").collect()]))
        assert not replay_to_end(writer, checkpoint).isActive

    run()
    full = [b for b in batches if b]
    assert [r for b in full for r in b] == [(v, i + 1) for i, v in enumerate(LINES[:6])]
    assert all(len(b) <= 2 for b in full)
    with open(os.path.join(d, "003.txt"), "w") as f:
        f.write("new\n")
    batches.clear()
    run()  # goes on behind the last committed line
    assert [r for b in batches for r in b] == [("new", 7)]


def test_line_replay_can_be_cancelled(spark):
    spark.dataSource.register(LineReplay)
    d = folder(b"".join(b"%d\n" % i for i in range(100_000)))
    seen = []
    stream = spark.readStream.format("line_replay").option("path", d).load()
    query = stream.writeStream.foreachBatch(lambda b, i: seen.extend(r["value"] for r in b.collect()))
    query = query.option("checkpointLocation", tempfile.mkdtemp(prefix="tm-ck-")).trigger(processingTime="0 seconds").start()
    while len(seen) < 3 and query.isActive:
        query.awaitTermination(0.2)
    query.stop()
    assert 3 <= len(seen) < 1000 and seen == [str(i) for i in range(len(seen))]


def test_kafka_values_and_collections(spark):
    raw = spark.createDataFrame(
        [(bytearray("é,1".encode()), 0, 7, None), (None, 1, 8, None)],
        "value binary, partition int, offset long, timestamp timestamp",
    )
    rows = S.kafka_values(raw).orderBy("offset").collect()
    assert [(r["value"], r["partition"], r["offset"]) for r in rows] == [("é,1", 0, 7), (None, 1, 8)]
    pairs = S.from_collection(spark, [("a", 1), (None, 2)])
    assert [r["_1"] for r in S.first_field(pairs).collect()] == ["a", None]


def sizes(path):
    return [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_files_roll_by_size(spark):
    """25 MB of rows in one task: no file above 10 MiB, by the estimate and by the mean row."""
    out = tempfile.mkdtemp(prefix="tm-roll-")
    short = spark.range(600_000).coalesce(1).select(F.lpad(F.col("id").cast("string"), 40, "x").alias("value"))
    K.write_text_buckets(short, f"{out}/a", bucket=None)
    assert len(sizes(f"{out}/a")) >= 3 and max(sizes(f"{out}/a")) <= K.MAX_PART_BYTES
    wide = spark.range(60_000).coalesce(1).select(F.lpad(F.col("id").cast("string"), 400, "x").alias("value"))
    K.write_text_buckets(wide, f"{out}/b", bucket=None, max_records=K.records_per_file(wide))
    assert len(sizes(f"{out}/b")) == 3 and max(sizes(f"{out}/b")) <= K.MAX_PART_BYTES


def test_stream_files_roll_by_size(spark):
    out, source = tempfile.mkdtemp(prefix="tm-roll-"), tempfile.mkdtemp(prefix="tm-in-")
    wide = spark.range(400_000).coalesce(1).select(F.lpad(F.col("id").cast("string"), 40, "x").alias("value"))
    wide.write.mode("append").parquet(source)
    stream = spark.readStream.schema("value string").parquet(source).coalesce(1)
    writer = K.text_file_sink(stream, f"{out}/rows", f"{out}/ck", bucket=None).trigger(availableNow=True)
    writer.start().awaitTermination()
    assert spark.read.text(f"{out}/rows").count() == 400_000
    assert len(sizes(f"{out}/rows")) >= 2 and max(sizes(f"{out}/rows")) <= K.MAX_PART_BYTES


def test_bucket_write_reads_its_input_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    rows = spark.range(5000).selectExpr("cast(id as string) as value", "cast(id % 7 as string) as bucket")
    out = f"{tempfile.mkdtemp(prefix='tm-once-')}/{uuid.uuid4().hex}"
    K.write_text_buckets(rows.mapInArrow(count, rows.schema), out)
    assert calls.value == 5000
    back = spark.read.schema("value string, bucket string").text(out)
    assert sorted(r["count"] for r in back.groupBy("bucket").count().collect()) == [714] * 5 + [715] * 2


LEFT = [(1, "a"), (1, "b"), (None, "n"), (2, "c")]
RIGHT = [(1, 5.0), (None, 6.0), (None, 7.0), (9, 8.0)]


def frames(spark, left=LEFT, right=RIGHT):
    return spark.createDataFrame(left, "k long, v string").repartition(3), spark.createDataFrame(right, "rk long, side double").repartition(2)


def test_cogroup_function_sees_both_sides(spark):
    def fn(key, lefts, rights):
        yield key, ",".join(sorted(r["v"] for r in lefts)), sum(r["side"] for r in rights)

    got = B.cogroup_apply(*frames(spark), "k", "rk", fn, "key long, vs string, total double").collect()
    want = {1: ("a,b", 5.0), None: ("n", 13.0), 2: ("c", 0.0), 9: ("", 8.0)}
    assert {r["key"]: (r["vs"], r["total"]) for r in got} == want and len(got) == 4


def test_cogroup_function_may_stop_early_or_return_nothing(spark):
    def first(key, lefts, rights):
        for r in lefts:
            yield (r["v"][:1],)
            return

    left, right = frames(spark)
    got = sorted(r["v"] for r in B.cogroup_apply(left, right, "k", "rk", first, "v string").collect())
    assert got in (["a", "c", "n"], ["b", "c", "n"])
    assert B.cogroup_apply(left.limit(0), right.limit(0), "k", "rk", first, "v string").count() == 0
    assert [r["v"] for r in B.cogroup_apply(left.limit(0), right, "k", "rk", first, "v string").collect()] == []
    with pytest.raises(ValueError):
        B.cogroup_apply(left.withColumn("k", F.col("k").cast("string")), right, "k", "rk", first, "v string")


def test_cogroup_of_a_hot_key_holds_one_batch(spark):
    """Three quarters of all rows have one key; the function streams over them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        left = spark.range(20_000).selectExpr("if(id % 4 = 0, id, -1) as k", "id as v")
        right = spark.range(5_000).selectExpr("if(id % 4 = 0, id, -1) as rk", "id as w")

        def fn(key, lefts, rights):
            yield key, sum(1 for _ in lefts), sum(1 for _ in rights)

        got = {r["key"]: (r["n"], r["m"]) for r in B.cogroup_apply(left, right, "k", "rk", fn, "key long, n long, m long").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[-1] == (15_000, 3_750) and len(got) == 5_001 and got[4] == (1, 1) and got[19_996] == (1, 0)
