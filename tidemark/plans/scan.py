"""Skew-safe running aggregates over a total order (prefix and suffix scans).

Many operators of this library need "the aggregate of every row before (or
after) this one" in arrival or event-time order: the watermark in force when a
row arrived, the i-th element of a keyed list, the next row that satisfies a
pattern step.  A plain ``Window.partitionBy(key).orderBy(seq)`` puts a whole key
(or, for a global order, the whole table) into one task.  ``scan`` avoids that
with the classic two-phase parallel prefix:

1. cut the order column into contiguous buckets of bounded size,
2. aggregate every (key, bucket) - partial aggregation, tiny result,
3. scan the bucket table (recursively, it is smaller by the bucket factor),
4. inject each bucket's carry as one extra row at the head of the bucket and
   run a bounded window inside ``partitionBy(key, bucket)``.

Step 4 uses a union rather than a join, so the big side is shuffled exactly
once and a NULL partition key behaves like any other key, as in ``groupBy``.

Only associative aggregates are supported: ``min``, ``max`` (also on structs,
which gives "first / last row satisfying p"), ``sum`` (counts are sums of
0/1 flags) and ``xor`` (fingerprints of prefixes).  Suffix scans run over the reversed order with a preceding frame,
which Spark evaluates in linear time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.lineage import cut

# Upper bound of rows per bucket; each bucket is one bounded window partition.
DEFAULT_BUCKET_ROWS = 1 << 15
# Keyed inputs whose largest key provably holds at most this many rows (about
# one ordinary task of data) are scanned with one plain window per key: fewer
# stages, and no partition can exceed a normal task whatever the skew.  A key
# above this bound, and any global order, is bucketed.
DIRECT_MAX_ROWS = 1 << 20
# Largest carry table (one row per bucket) that is broadcast to the rows.
BROADCAST_MAX_ROWS = 1 << 18
# Lower bound, so that small inputs do not pay for many tiny buckets.
MIN_BUCKET_ROWS = 1 << 10

# Marks the rows of hot keys inside a keyed scan.
HOT = "__hot"

_AGG = {"min": F.min, "max": F.max, "sum": F.sum, "xor": F.bit_xor}


@dataclass(frozen=True)
class OrderStats:
    """Bounds of the leading order column and an upper bound of rows per key.

    Bounds computed on a superset stay valid for any subset (or for rows
    derived from it that keep the column), which lets a pipeline compute them
    once on its base table instead of re-running its lineage before each scan.
    """

    lo: int
    hi: int
    n: int
    #: Keyed bounds only: the keys of more than DIRECT_MAX_ROWS rows, one row each, written.
    hot: DataFrame | None = None


def order_stats(df: DataFrame, col: str) -> OrderStats:
    """One small aggregate job: min/max/count of the leading order column."""
    return order_stats_multi(df, [col])[col]


def order_stats_multi(df: DataFrame, cols: Sequence[str]) -> dict[str, OrderStats]:
    """Bounds of several order columns in one aggregate job."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}")]
    row = df.agg(*aggs).first()
    return _unpack(row, cols, row["__n"] if row is not None else 0)


def keyed_order_stats(df: DataFrame, cols: Sequence[str], key: Sequence[str]) -> tuple[dict, dict]:
    """``(global, per_key)`` bounds in one job; ``per_key`` uses the largest key's row count.

    The per-key bound stays valid for any scan partitioned by a superset of
    ``key`` on these rows or a subset of them, so a job decides once whether
    some key is hot (needs buckets) or every key fits one bounded window.  If
    some are, they are written as ``hot``, so that only they are bucketed.
    """
    per = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__c"),
        *[x for i, c in enumerate(cols) for x in (F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}"))],
    )
    aggs = [F.sum("__c").alias("__n"), F.max("__c").alias("__k")]
    for i in range(len(cols)):
        aggs += [F.min(f"__lo{i}").alias(f"__lo{i}"), F.max(f"__hi{i}").alias(f"__hi{i}")]
    row = per.agg(*aggs).first()
    n = row["__n"] if row is not None and row["__n"] is not None else 0
    k = row["__k"] if row is not None and row["__k"] is not None else 0
    of_key = _unpack(row, cols, k)
    if k > DIRECT_MAX_ROWS:
        hot = cut(per.where(F.col("__c") > DIRECT_MAX_ROWS).select(*key), "hot-keys")
        of_key = {c: replace(st, hot=hot) for c, st in of_key.items()}
    return _unpack(row, cols, n), of_key


def _unpack(row, cols: Sequence[str], n: int) -> dict[str, OrderStats]:
    out = {}
    for i, c in enumerate(cols):
        if row is None or not n or row[f"__lo{i}"] is None:
            out[c] = OrderStats(0, 0, 0)
        else:
            out[c] = OrderStats(int(row[f"__lo{i}"]), int(row[f"__hi{i}"]), int(n))
    return out


def auto_bucket_rows(df: DataFrame, n: int) -> int:
    """Rows per bucket: about four buckets per core, within [MIN, DEFAULT]."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return int(min(DEFAULT_BUCKET_ROWS, max(MIN_BUCKET_ROWS, n // max(1, 4 * cores))))


def scan(
    df: DataFrame,
    order_by: Sequence[str],
    aggs: Mapping[str, tuple[str, Column | str]],
    partition_by: Sequence[str] = (),
    following: bool = False,
    inclusive: bool = False,
    bucket_rows: int | None = None,
    stats: OrderStats | None = None,
    balanced: bool | None = None,
    bucket: str | None = None,
) -> DataFrame:
    """Add one column per ``aggs`` entry: ``name -> (fn, expr)``.

    ``order_by`` lists columns whose lexicographic order is total (for
    example ``["seq"]`` or ``["ts_ms", "seq"]``); the first one must be an
    integral column and is the one that is bucketed.  The value of a new column
    is ``fn(expr)`` over the rows of the same ``partition_by`` key that come
    before the row (``following=False``) or after it (``following=True``),
    including the row itself when ``inclusive``.  Empty frames give NULL for
    min/max and 0 for sum and xor.  ``stats`` may be bounds computed on a superset;
    ``bucket_rows`` defaults to ``auto_bucket_rows``.  ``balanced=True`` skips
    the hot-bucket check (the caller already ran ``lead_is_balanced``).  Rows of
    keys outside ``stats.hot`` stay in one bucket per key, without a carry.

    ``bucket`` (global orders only) names a bucket column that is kept in the
    output and reused when already present: chained scans over the same order
    then share one partitioning of the rows, and carries arrive by a join on
    the bucket (the small carry table is shuffled, the rows are not).
    """
    order_by = list(order_by)
    keys = list(partition_by)
    if stats is None:
        stats = order_stats(df, order_by[0])
    if stats.hot is not None and not set(stats.hot.columns) <= set(keys):
        stats = replace(stats, hot=None)
    if (
        balanced is not True
        and not (bucket is not None and bucket in df.columns)
        and needs_buckets(stats, bucket_rows, keyed=bool(keys), df=df)
        and not lead_is_balanced(df, order_by[0], keys, stats, bucket_rows, unique=len(order_by) == 1)
    ):
        # a busy value of the lead, an outlier that stretches its range or a dense
        # burst fills more than a task: bucket the order on its dense ordinal instead
        from tidemark.plans.ordinal import with_ordinal

        ranked = with_ordinal(df, order_by, "__ord")
        dense = replace(order_stats(ranked, "__ord"), hot=stats.hot)
        out = scan(ranked, ["__ord"], aggs, partition_by, following, inclusive, bucket_rows, dense, True, bucket)
        return out.drop("__ord")
    # Keyed inputs whose largest key is small need no buckets: the rows are
    # already spread by key and every window partition is bounded.  A global
    # order always uses buckets beyond one bucket's worth of rows, so the
    # whole input never funnels through one task.
    direct_rows = DIRECT_MAX_ROWS if (bucket_rows is None and keys) else 0
    if bucket_rows is None:
        bucket_rows = auto_bucket_rows(df, stats.n)
    bucket_rows = max(2, bucket_rows)  # every recursion level shrinks the input at least twofold
    cols = list(df.columns)
    if bucket is not None and bucket not in cols:
        cols.append(bucket)
    vin = {name: f"__in_{i}" for i, name in enumerate(aggs)}
    staged = df.withColumns(
        {vin[name]: (F.col(e) if isinstance(e, str) else e) for name, (_, e) in aggs.items()}
    )
    fns = {name: fn for name, (fn, _) in aggs.items()}
    if bucket is not None and not keys:
        out = _scan_joined(staged, order_by, vin, fns, following, inclusive, bucket_rows, stats, bucket)
    else:
        out = _scan_staged(staged, order_by, vin, fns, keys, following, inclusive, bucket_rows, stats, 0, direct_rows)
    result = out.select(*cols, *[F.col(f"__out_{vin[n]}").alias(n) for n in aggs])
    return result


def needs_buckets(
    stats: OrderStats, bucket_rows: int | None = None, keyed: bool = False, df: DataFrame | None = None
) -> bool:
    """Whether ``scan`` would take the two-phase path for inputs within ``stats``."""
    if bucket_rows is None:
        if keyed:
            return stats.n > DIRECT_MAX_ROWS
        bucket_rows = auto_bucket_rows(df, stats.n) if df is not None else MIN_BUCKET_ROWS
    return stats.n > max(2, bucket_rows)


def lead_is_balanced(
    df: DataFrame,
    lead: str,
    keys: Sequence[str],
    stats: OrderStats,
    bucket_rows: int | None = None,
    unique: bool = False,
) -> bool:
    """One small job: does every (key, bucket of ``lead``) stay within one task?

    Equal-width buckets are bounded only if the lead is spread evenly and few
    rows share a value; this measures them with the same width ``scan`` uses.
    Inputs that fit one task as a whole need no job.  A ``unique`` lead may fill
    two buckets' worth of rows, whatever the bound of a task.
    """
    if stats.n <= DIRECT_MAX_ROWS:
        return True
    if bucket_rows is None:
        bucket_rows = auto_bucket_rows(df, stats.n)
    bucket_rows = max(2, bucket_rows)
    most = max(DIRECT_MAX_ROWS, 2 * bucket_rows) if unique else DIRECT_MAX_ROWS
    span = stats.hi - stats.lo + 1
    width = max(1, -(-span * bucket_rows // max(1, stats.n)))
    b = F.expr(f"(`{lead}` - {stats.lo}) div {width}")
    row = df.groupBy(*keys, b.alias("__b")).agg(F.count(F.lit(1)).alias("__c")).agg(F.max("__c").alias("m")).first()
    return row is None or row["m"] is None or row["m"] <= most


def _direction(cols: Sequence[str], following: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if following else F.col(c).asc_nulls_first() for c in cols]


def _scan_staged(
    df: DataFrame,
    order_by: list[str],
    vin: Mapping[str, str],
    fns: Mapping[str, str],
    keys: list[str],
    following: bool,
    inclusive: bool,
    bucket_rows: int,
    stats: OrderStats,
    depth: int = 0,
    direct_rows: int = 0,
) -> DataFrame:
    """Scan on pre-staged input columns ``vin``; outputs ``__out_<vin>``."""
    end = Window.currentRow if inclusive else -1
    if stats.n <= max(bucket_rows, direct_rows):
        # Every key holds at most that many rows: one bounded window per key.
        w = (
            Window.partitionBy(*keys)
            .orderBy(*_direction(order_by, following))
            .rowsBetween(Window.unboundedPreceding, end)
        )
        return df.withColumns(
            {f"__out_{v}": _finish(fns[n], _AGG[fns[n]](v).over(w)) for n, v in vin.items()}
        )

    span = stats.hi - stats.lo + 1
    width = max(1, -(-span * bucket_rows // stats.n))
    level = f"__b{depth}"
    place = F.expr(f"(`{order_by[0]}` - {stats.lo}) div {width}")
    if stats.hot is not None:
        # only the hot keys are cut; every other key keeps one bucket
        bucketed = _mark_hot(df, stats.hot).withColumn(level, F.when(F.col(HOT), place).otherwise(F.lit(0)))
        staged = bucketed.where(HOT)
    else:
        bucketed = staged = df.withColumn(level, place)

    # Phase 1: per-(key, bucket) aggregate; partial aggregation keeps it cheap.
    table = staged.groupBy(*keys, level).agg(*[_AGG[fns[n]](v).alias(v) for n, v in vin.items()])
    n_buckets = (stats.hi - stats.lo) // width + 1
    carried = _scan_staged(
        table,
        [level],
        vin,
        fns,
        keys,
        following,
        False,
        bucket_rows,
        OrderStats(0, n_buckets - 1, n_buckets),
        depth + 1,
    )
    # Phase 2: the carry of each bucket enters as a head row of that bucket.
    mark = "__head"
    heads = carried.select(
        *keys,
        level,
        F.lit(0).alias(mark),
        *[F.col(f"__out_{v}").alias(v) for v in vin.values()],
    )
    body = bucketed.withColumn(mark, F.lit(1))
    both = body.unionByName(heads, allowMissingColumns=True)
    w = (
        Window.partitionBy(*keys, level)
        .orderBy(F.col(mark), *_direction(order_by, following))
        .rowsBetween(Window.unboundedPreceding, end)
    )
    return (
        both.withColumns(
            {f"__out_{v}": _finish(fns[n], _AGG[fns[n]](v).over(w)) for n, v in vin.items()}
        )
        .where(F.col(mark) == 1)
        .drop(mark, level, HOT)
    )


def _mark_hot(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Add ``HOT``: whether the row's key is in ``hot`` (NULL counts as a key).

    A hot key has more than DIRECT_MAX_ROWS rows, so there are few; they are
    broadcast under a counted bound, else joined.
    """
    names = {c: f"__hot_{i}" for i, c in enumerate(hot.columns)}
    side = hot.select(*[F.col(c).alias(n) for c, n in names.items()], F.lit(True).alias(HOT))
    if hot.count() <= BROADCAST_MAX_ROWS:
        side = F.broadcast(side)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    marked = df.join(side, reduce(and_, same), "left").drop(*names.values())
    return marked.withColumn(HOT, F.coalesce(F.col(HOT), F.lit(False)))


def _scan_joined(
    df: DataFrame,
    order_by: list[str],
    vin: Mapping[str, str],
    fns: Mapping[str, str],
    following: bool,
    inclusive: bool,
    bucket_rows: int,
    stats: OrderStats,
    bucket: str,
) -> DataFrame:
    """Global scan whose bucket column is kept: carries arrive by a join.

    A NULL order value goes to bucket -1, which sorts first ascending and last
    descending, like NULLs in the window order.
    """
    span = stats.hi - stats.lo + 1
    width = max(1, -(-span * bucket_rows // max(1, stats.n)))
    if bucket not in df.columns:
        df = df.withColumn(bucket, F.coalesce(F.expr(f"(`{order_by[0]}` - {stats.lo}) div {width}"), F.lit(-1)))
    table = df.groupBy(bucket).agg(*[_AGG[fns[n]](v).alias(v) for n, v in vin.items()])
    n_buckets = (stats.hi - stats.lo) // width + 2
    carried = _scan_staged(table, [bucket], vin, fns, [], following, False, bucket_rows,
                           OrderStats(-1, n_buckets - 2, n_buckets), 1)
    carry = carried.select(bucket, *[F.col(f"__out_{v}").alias(f"__carry_{v}") for v in vin.values()])
    end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(bucket).orderBy(*_direction(order_by, following)).rowsBetween(Window.unboundedPreceding, end)
    # the carry table has at most n_buckets rows: broadcast it only under that
    # proven bound; above it, the join shuffles the carry table to the rows'
    # existing bucket partitioning
    if n_buckets <= BROADCAST_MAX_ROWS:
        carry = F.broadcast(carry)
    joined = df.join(carry, bucket, "left")
    return joined.withColumns(
        {
            f"__out_{v}": _finish(fns[n], _combine(fns[n], _AGG[fns[n]](v).over(w), F.col(f"__carry_{v}")))
            for n, v in vin.items()
        }
    ).drop(*[f"__carry_{v}" for v in vin.values()])


def _combine(fn: str, a: Column, b: Column) -> Column:
    if fn == "max":
        return F.greatest(a, b)
    if fn == "min":
        return F.least(a, b)
    a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return a.bitwiseXOR(b) if fn == "xor" else a + b


def _finish(fn: str, c: Column) -> Column:
    return F.coalesce(c, F.lit(0)) if fn in ("sum", "xor") else c


def row_number(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """Dense 1-based position inside ``partition_by`` in ``order_by`` order (skew-safe)."""
    return scan(df, order_by, {name: ("sum", F.lit(1))}, partition_by, inclusive=True, **kw)
