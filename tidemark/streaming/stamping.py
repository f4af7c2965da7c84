"""Exact watermarks on a stream (T6): every row with the watermark in force when it arrived.

Spark moves its watermark between micro-batches.  ``WatermarkStamper`` is a ``foreachBatch``
function that stamps each row as ``plans.watermark`` does on tables: a scan within the batch,
on top of the running maxima carried from the batches before.  Each row gets

* ``wm_ms``: the watermark when it arrived (NULL until every source has a row),
* ``after_ms``: the watermark after it,
* ``clock_ms``: the running max of event time over all sources.

Stamped batches are ordered folders.  ``stamped_stream`` reads them as a stream whose Spark
watermark is ``after_ms`` itself, so at the start of each batch it equals the exact watermark
after the batch before, also for a union of sources.  The time column that carries it is
dropped behind ``withWatermark``: stateful operators then get the watermark and their timers,
but Spark drops no row by itself, as the stamps say exactly which rows are late.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType
from pyspark.sql.utils import AnalysisException

from tidemark.plans.scan import scan
from tidemark.plans.watermark import WatermarkSpec, event_ts
from tidemark.streaming.replay import exists, read_ordered, write_ordered

STAMPS = ("wm_ms", "after_ms", "clock_ms")
#: ``after_ms`` of the row that ends a stream (9999-01-01): every timer is due, no row follows.
END_MS = 253_370_764_800_000
_AFTER = "__after_ts"


class Maxima:
    """Running max event time of every source after each batch, one tiny folder per batch."""

    def __init__(self, path: str, n: int):
        self.path, self.names = path, [f"max{i}" for i in range(n)]

    def before(self, spark: SparkSession, batch_id: int) -> list:
        none = [None] * len(self.names)
        try:  # batch ids are consecutive: one tiny file to read
            row = spark.read.parquet(f"{self.path}/batch_id={batch_id - 1}").first()
        except AnalysisException:
            try:  # first batch, or a gap after a restart
                prev = spark.read.parquet(self.path)
            except AnalysisException:
                return none
            row = prev.where(F.col("batch_id") < batch_id).agg(*[F.max(n).alias(n) for n in self.names]).first()
        return none if row is None else [row[n] for n in self.names]

    def write(self, spark: SparkSession, batch_id: int, values: list) -> None:
        schema = ", ".join(f"{n} bigint" for n in self.names)
        spark.createDataFrame([tuple(values)], schema).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


class WatermarkStamper:
    """``foreachBatch`` function: stamped rows in ``<out>/rows``, carried maxima in ``<out>/_max``.

    With ``stream``/``streams`` the input is a union of sources and the watermark is the minimum
    of the sources' own.  A batch that is run again after a failure finds its folder in place.
    """

    def __init__(self, out: str, spec: WatermarkSpec, ts: str = "time_stamp", order: str = "seq",
                 stream: str | None = None, streams=()):
        self.out, self.spec, self.ts, self.order, self.stream = out.rstrip("/"), spec, ts, order, stream
        self.streams = list(streams) if stream is not None else [None]
        self.maxima = Maxima(f"{self.out}/_max", len(self.streams))

    def _value(self, s) -> Column:
        return F.col(self.ts) if s is None else F.when(F.col(self.stream) == F.lit(s), F.col(self.ts))

    def stamp(self, batch: DataFrame, carry: list) -> DataFrame:
        """``batch`` with the stamps, given the maxima before it."""
        aggs = {f"__pm{i}": ("max", self._value(s)) for i, s in enumerate(self.streams)}
        within = scan(batch, [self.order], aggs)
        known = [F.lit(c).cast("bigint") for c in carry]
        before = [self._most(known[i], F.col(f"__pm{i}")) for i in range(len(known))]
        after = [self._most(b, self._value(s)) for b, s in zip(before, self.streams)]
        lag = F.lit(self.spec.lag_ms)
        clock = self._most(*after)
        return within.withColumns(
            {"wm_ms": self._least(before) - lag, "after_ms": self._least(after) - lag, "clock_ms": clock}
        ).drop(*aggs)

    @staticmethod
    def _most(*cols: Column) -> Column:
        return F.greatest(*cols) if len(cols) > 1 else cols[0]

    @staticmethod
    def _least(cols: list[Column]) -> Column:
        """The minimum, NULL as long as one is NULL."""
        missing = F.lit(False)
        for c in cols:
            missing = missing | c.isNull()
        return F.when(~missing, F.least(*cols) if len(cols) > 1 else cols[0])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"{self.out}/rows/batch_id={batch_id:09d}"
        if exists(spark, target):
            return
        batch.persist()  # the scan reads it several times, the source only once
        try:
            carry = self.maxima.before(spark, batch_id)
            row = batch.agg(*[F.max(self._value(s)).alias(f"m{i}") for i, s in enumerate(self.streams)]).first()
            best = [max((v for v in (c, row[f"m{i}"]) if v is not None), default=None) for i, c in enumerate(carry)]
            self.maxima.write(spark, batch_id, best)
            write_ordered(self.stamp(batch, carry), self.order, target)
        finally:
            batch.unpersist()

    def end(self, spark: SparkSession, schema: StructType) -> None:
        """Close the stream (L4): one row behind all others moves the watermark past every timer."""
        last = spark.createDataFrame([()], StructType()).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in stamped_schema(schema) if f.name != "after_ms"],
            F.lit(END_MS).alias("after_ms"),
        )
        write_ordered(last, "after_ms", f"{self.out}/rows/end", 1, after_ms=int(time.time() * 1000) + 1000)

    def rows(self, spark: SparkSession, schema: StructType, files_per_trigger: int = 1,
             bytes_per_trigger: int | None = None) -> DataFrame:
        return stamped_stream(spark, f"{self.out}/rows", schema, files_per_trigger, bytes_per_trigger)


def stamped_schema(schema: StructType) -> StructType:
    out = StructType([f for f in schema if f.name not in STAMPS])
    for name in STAMPS:
        out = out.add(name, LongType())
    return out


def stamped_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1,
                   bytes_per_trigger: int | None = None) -> DataFrame:
    """Stamped rows as a stream whose watermark is their exact one; ``schema`` without stamps."""
    raw = read_ordered(spark, path, stamped_schema(schema), files_per_trigger, bytes_per_trigger)
    timed = raw.withColumn(_AFTER, event_ts(F.coalesce("after_ms", F.lit(0)))).withWatermark(_AFTER, "0 seconds")
    # Spark moves filters on other columns before ``withWatermark``, and rows that are filtered
    # there would not count for the watermark: so every column reads the time column.  The
    # closing row counts and goes no further.
    open_ = F.col(_AFTER) < event_ts(F.lit(END_MS))
    return timed.where(open_).select(*[F.when(open_, F.col(c)).alias(c) for c in raw.columns])
