"""Dense ordinal of a composite total order (e.g. event time, then arrival).

Bucketed scans bound every bucket by the number of distinct values of the
leading order column, which holds only when that column is unique.  For a
composite order such as ``(time_stamp, seq)`` a single busy timestamp could
fill one bucket, so before bucketing such an order we give every row its dense
position ``0..n-1`` in it:

1. a global ``orderBy`` on the (unique) composite key: Spark samples range
   bounds on the whole key, so even one hot timestamp is split over tasks;
2. each row records its partition and its running id inside the partition
   while the sorted result is written to the checkpoint folder (a cut, so the
   ids are fixed even if an executor is lost later);
3. per-partition row counts (one row per partition: a table whose size is
   bounded by the partition count) give offsets by a small running sum, and
   are broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.lineage import cut

_ID_BITS = 33  # monotonically_increasing_id keeps the partition index above bit 33


def with_ordinal(df: DataFrame, order_by: Sequence[str], out: str = "__ord") -> DataFrame:
    """``df`` plus ``out``: the row's 0-based position in ``order_by`` order."""
    ranked = cut(
        df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).withColumns(
            {"__pid": F.spark_partition_id(), "__mid": F.monotonically_increasing_id()}
        ),
        "ordinal",
    )
    counts = ranked.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition of the sort: bounded by the partition count
    offsets = counts.select(
        "__pid",
        (F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"),
    ).fillna(0, ["__off"])
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _ID_BITS)
    return (
        ranked.join(F.broadcast(offsets), "__pid")
        .withColumn(out, (F.col("__off") + local).cast("long"))
        .drop("__pid", "__mid", "__off")
    )
