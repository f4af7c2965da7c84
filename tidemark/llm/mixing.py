"""Mixing sources to target weights (6): Pfair scheduling, with DataFrame functions.

Rows of a source are dealt into blocks of ``block_rows`` rows in a fixed pseudo-random
order.  With the exact weight w of a source, as a fraction of the sum of all, block j (from 0)
is released at floor(j / w) and due at ceil((j + 1) / w).  Earliest deadline first among
the released blocks meets every deadline, so at any slot each source is less than one block
from weight * slots, however long the schedule and however uneven the weights.  Releases and
deadlines are whole numbers of any size (a weight is the decimal fraction that it is written
as), so nothing is rounded.  The driver runs through the slots, one per ``block_rows`` rows,
and writes them in chunks of ``frame_slots``; every block finds its slot in that table.
Ordinals come from ``keyed_ordinal``, so a hot source is spread over many tasks.

Target weights are a table (source, weight), or by default each source's share of the
blocks, with which the mixture holds every row once.  Given weights are kept as long as no
source runs out: ``selected`` marks the rows of that mixture, the blocks beyond it follow,
source after source.  A source with a weight but without rows leaves its slots empty.

Cases: a null source is a source; rows that repeat a doc_id are rows of their own, their
order open; sources without a weight are not selected and have no slot; the text is not
read; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, keyed_ordinal, read_table
from tidemark.session import scratch_path

BLOCK_ROWS = 16
#: Columns of a scheduled row: its slot and its place in the slot's block.
MIX_ORDER = ("mix_slot", "mix_place")
#: Slots that the driver holds before it writes them.
FRAME_SLOTS = 1 << 18


def whole_weights(weights: list[float | int]) -> list[int]:
    """Whole numbers in exactly the same proportions."""
    exact = [Fraction(repr(w)) for w in weights]
    unit = math.lcm(*[w.denominator for w in exact]) if exact else 1
    return [int(w * unit) for w in exact]


def schedule(ks: list[int], slots: int) -> Iterator[tuple[int, int]]:
    """(i, j) of each of the first ``slots`` slots: the j-th block of source i; weights ``ks`` / sum."""
    whole = sum(ks)
    released = [(0, i, 0) for i in range(len(ks))]  # a heap
    ready: list[tuple[int, int, int]] = []
    for t in range(slots):
        while released and released[0][0] <= t:
            _, i, j = heapq.heappop(released)
            heapq.heappush(ready, (-(-(j + 1) * whole // ks[i]), i, j))
        _, i, j = heapq.heappop(ready)
        heapq.heappush(released, ((j + 1) * whole // ks[i], i, j + 1))
        yield i, j


def write_schedule(spark: SparkSession, names: list, ks: list[int], slots: int, frame_slots: int) -> tuple[DataFrame, list[int]]:
    """``(f_source, j, slot)`` of all slots, written, and the blocks of each source in them."""
    path, run, taken = scratch_path(spark, "mix-schedule"), schedule(ks, slots), [0] * len(ks)
    sources = pa.array(names, pa.string())
    for first in range(0, max(slots, 1), frame_slots):  # one empty chunk if there are no slots
        part = [x for _, x in zip(range(min(frame_slots, slots - first)), run)]
        for i, j in part:
            taken[i] = j + 1
        table = pa.table(
            {
                "f_source": sources.take(pa.array([i for i, _ in part], pa.int64())),
                "j": pa.array([j for _, j in part], pa.int64()),
                "slot": pa.array(range(first, first + len(part)), pa.int64()),
            }
        )
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.parquet(path), taken


def mix(
    docs: DataFrame, targets: DataFrame | None = None, block_rows: int = BLOCK_ROWS, frame_slots: int = FRAME_SLOTS,
) -> DataFrame:
    """Per row: doc_id, source, block, slot, place (in the block), selected.

    Reading by (slot, place) is the mixture.
    """
    spark = docs.sparkSession
    rows = cut(docs.select("doc_id", F.col("source").cast("string").alias("source")), "mix-rows")
    ranked = keyed_ordinal(rows, "source", ["doc_id"], "rank")
    ranked = ranked.withColumns({"block": F.floor(F.col("rank") / block_rows), "place": F.pmod("rank", F.lit(block_rows))})
    supply = cut(rows.groupBy("source").agg(F.ceil(F.count("*") / block_rows).alias("blocks")), "mix-supply")
    if targets is None:
        plan = supply.withColumn("weight", F.col("blocks"))
    else:
        given = targets.select(F.col("source").cast("string").alias("w_source"), "weight").filter("weight > 0")
        plan = given.join(supply, F.col("source").eqNullSafe(F.col("w_source")), "left")
        plan = plan.select(F.col("w_source").alias("source"), "blocks", F.col("weight").cast("double").alias("weight"))
    # one row per source
    plan = sorted(plan.collect(), key=lambda r: (r["source"] is not None, r["source"] or ""))
    names, blocks = [r["source"] for r in plan], [r["blocks"] for r in plan]
    ks = whole_weights([r["weight"] for r in plan])
    slots = min((b * sum(ks) // k for b, k in zip(blocks, ks) if b is not None), default=0)
    table, taken = write_schedule(spark, names, ks, slots, frame_slots)
    after, ends = slots, []
    for name, b, n in zip(names, blocks, taken):
        ends.append((name, n, after))
        after += max((b or 0) - n, 0)
    ends = spark.createDataFrame(ends, "s_source string, taken long, after long")
    placed = ranked.join(ends, F.col("source").eqNullSafe(F.col("s_source")), "left")
    placed = placed.join(table, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("block") == F.col("j")), "left")
    slot = F.coalesce("slot", F.col("after") + F.col("block") - F.col("taken"))
    selected = F.col("slot").isNotNull().alias("selected")
    return placed.select("doc_id", "source", "block", slot.alias("slot"), "place", selected)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


def mixture(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that belong to the mixture: all of them without ``targets``.

    Rows of one doc_id and source are counted: as many of them stay as are selected.
    """
    tally = mix(docs, targets).groupBy(F.col("source").alias("g_source"), F.col("doc_id").alias("g_id"))
    tally = tally.agg(F.sum(F.col("selected").cast("long")).alias("keep"), F.count("*").alias("n"))
    beyond = cut(tally.filter("keep < n"), "beyond-mixture")
    if beyond.isEmpty():
        return docs
    on = docs["source"].cast("string").eqNullSafe(F.col("g_source")) & docs["doc_id"].eqNullSafe(F.col("g_id"))
    whole = docs.join(beyond, on, "left_anti")
    # rows are numbered only where some rows of a doc_id stay, the block border of a source
    split = docs.join(beyond.filter("keep > 0"), on)
    numbered = split.withColumn("__at", F.row_number().over(Window.partitionBy("g_source", "g_id").orderBy("g_id")))
    return whole.unionByName(numbered.filter("__at <= keep").select(docs.columns))


def scheduled(docs: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The rows of the mixture, whole, with their places in it: ``MIX_ORDER`` is the order to read them in.

    The schedule is made of keys and sources alone, so the texts move once, in the join with their
    places.  Rows of one doc_id and source take its places in any order; they are numbered for that.
    """
    key = lambda df: F.struct(F.col("doc_id"), df["source"].cast("string").alias("source"))  # noqa: E731  (nulls are equal in it)
    places = mix(docs, targets).filter("selected")
    places = places.select(key(places).alias("__key"), *[F.col(c).alias(m) for c, m in zip(("slot", "place"), MIX_ORDER)])
    # as many rows as there are texts, so never broadcast
    places = cut(places, "mix-places").hint("merge")
    kept = [docs[c] for c in docs.columns]
    keyed = docs.select(*kept, key(docs).alias("__key"))
    repeated = cut(docs.select(key(docs).alias("__r")).groupBy("__r").count().filter("count > 1").select("__r"), "mix-repeated")
    if repeated.isEmpty():
        return keyed.join(places, "__key").drop("__key")
    twice = lambda df, how: df.join(repeated, F.col("__key") == F.col("__r"), how)
    number = lambda df, *by: df.withColumn("__at", F.row_number().over(Window.partitionBy("__key").orderBy(*by)))
    split = number(twice(keyed, "left_semi"), "__key").join(number(twice(places, "left_semi"), *MIX_ORDER), ["__key", "__at"])
    once = twice(keyed, "left_anti").join(places, "__key")
    return once.unionByName(split.drop("__at")).drop("__key")
