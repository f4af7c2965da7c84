"""Helpers shared by the operators: written cuts, per-key ordinals, ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.lineage import cut

__all__ = ["cut", "keyed_ordinal", "read_table", "releasing", "split_by_ids"]

#: Rows that one (key, cell) of ``keyed_ordinal`` should hold, and cells of one prefix-sum window.
CELL_ROWS = 512
CELL_STEP = 1024
#: Bits of the bitmap of ``split_by_ids``: the least and the most (128 KB and 16 MB), and bits an id in between.
LEAST_BITS, MOST_BITS, BITS_AN_ID = 1 << 20, 1 << 27, 16


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with freed memory given back to the system at its end.

    Spark keeps Python workers between tasks, and the allocators keep what a task freed, so
    the workers of earlier stages would take memory from the later ones.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return whole


def split_by_ids(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``column`` may be among ``ids`` (one column, written), and the others.

    A bitmap of the hashed ids is broadcast, so no row is shuffled, however wide it is; about
    one in ``BITS_AN_ID`` of the other rows is in the first part too (more beyond
    ``MOST_BITS`` / ``BITS_AN_ID`` ids), so an exact join has to follow there.  Null counts as an id.
    """
    bits = LEAST_BITS
    while bits < min(BITS_AN_ID * ids.count(), MOST_BITS):
        bits *= 2
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1  # noqa: E731  (bitmap buckets begin at 1)
    maps = ids.select(place(F.col(ids.columns[0])).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("__bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))  # 4 KB a row, ``bits`` in all
    marked = df.withColumn("__place", place(F.col(column)))
    marked = marked.join(F.broadcast(maps), F.bitmap_bucket_number("__place") == F.col("__bucket"), "left")
    at = F.bitmap_bit_position("__place").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return marked.filter(hit).select(df.columns), marked.filter(~hit).select(df.columns)


def keyed_ordinal(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: a dense position from 0 of each row within its ``key``.

    A key's rows are dealt into cells by a hash of the ``order`` columns, about
    ``CELL_ROWS`` rows each, and numbered inside their cell; a cell starts where the
    previous ones end.  The order is a fixed pseudo-random one (cell, hash, order
    columns).  So a key that holds most rows is spread over many windows; counts come
    from map-side aggregates, their prefix sums run over one row per cell, in two
    levels.  Null keys count as one key.  ``df`` is read three times: cut it first.
    """
    sizes = cut(df.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n")), "key-sizes")
    h = F.xxhash64(*order)
    dealt = df.join(sizes, F.col(key).eqNullSafe(F.col("__k"))).withColumns(
        {"__h": h, "__cell": F.pmod(h, F.ceil(F.col("__n") / CELL_ROWS).cast("long"))}
    )
    counts = dealt.groupBy("__k", "__cell").agg(F.count("*").alias("__m"))
    counts = counts.withColumn("__group", F.floor(F.col("__cell") / CELL_STEP))
    groups = counts.groupBy("__k", "__group").agg(F.sum("__m").alias("__gm"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        F.col("__k").alias("__gk"),
        F.col("__group").alias("__gg"),
        F.coalesce(F.sum("__gm").over(before("__k").orderBy("__group")), F.lit(0)).alias("__gbase"),
    )
    base = cut(
        counts.withColumn("__cbase", F.coalesce(F.sum("__m").over(before("__k", "__group").orderBy("__cell")), F.lit(0)))
        .join(groups, F.col("__k").eqNullSafe(F.col("__gk")) & (F.col("__group") == F.col("__gg")))
        .select(F.col("__k").alias("__bk"), F.col("__cell").alias("__bc"), (F.col("__gbase") + F.col("__cbase")).alias("__base")),
        "cell-bases",
    )
    inside = Window.partitionBy("__k", "__cell").orderBy("__h", *order)
    return (
        dealt.withColumn("__rn", F.row_number().over(inside))
        .join(base, F.col("__k").eqNullSafe(F.col("__bk")) & (F.col("__cell") == F.col("__bc")))
        .withColumn(out, (F.col("__base") + F.col("__rn") - 1).cast("long"))
        .drop("__h", "__cell", "__k", "__n", "__bk", "__bc", "__base", "__rn")
    )

