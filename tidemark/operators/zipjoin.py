"""Keyed FIFO zip of step streams (Z1-Z4) with state expiry (ST2, ST3).

The reference keeps one list per step and key; when every list is non-empty it
emits the head of each list and pops them.  Because at most one tuple can
complete per event (some list is empty after every event), the i-th emitted
tuple of a key is exactly the i-th element of every step list, and it is
emitted by the event that brought the last of those elements.  In batch this is
a running count per (key, step) - a skew-safe scan - followed by a group on
(key, i) that holds at most one row per step.

Expiry:

* idle TTL, refreshed on read and write: every event reads every list, so the
  state of a key is cleared exactly when two arrivals of the key are ``ttl`` or
  more apart.  That is a gap session; the zip runs per (key, session).
* write TTL, refreshed on create and write: each element expires ``ttl`` after
  it was written and a pop rewrites (renews) the survivors.  This is order
  dependent, so it runs as a sequential fold per (key, gap session) in
  ``mapInPandas`` over data that Spark has partitioned and sorted; the fold
  holds only the live lists, never the group.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scan import OrderStats, row_number, scan


def contains_routes(steps: Sequence[str], content: str = "content") -> dict[str, Column]:
    """The reference's routing: an event joins list ``s`` when its content contains ``s``."""
    return {s: F.col(content).contains(F.lit(s)) for s in steps}


def prefix_routes(steps: Sequence[str], content: str = "content") -> dict[str, Column]:
    return {s: F.col(content).startswith(F.lit(s)) for s in steps}


def route_steps(df: DataFrame, routes: Mapping[str, Column], out: str = "step") -> DataFrame:
    """One output row per (event, matching step) (P7); events matching nothing vanish."""
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in routes.items()])
    return df.withColumn(out, F.explode(F.filter(tags, lambda x: x.isNotNull())))


def gap_sessions(
    df: DataFrame, key: str, ttl_ms: int, clock: str = "clock_ms", order: str = "seq", out: str = "session",
    stats: OrderStats | None = None,
) -> DataFrame:
    """Session number per key: a new one starts when the previous arrival of the
    key is ``ttl_ms`` or more before this one (ST2)."""
    prev = scan(df, [order], {"__prev": ("max", F.col(clock))}, partition_by=[key], stats=stats)
    flagged = prev.withColumn(
        "__new", F.when(F.col("__prev").isNull() | (F.col(clock) - F.col("__prev") >= ttl_ms), 1).otherwise(0)
    )
    sess = scan(flagged, [order], {out: ("sum", F.col("__new"))}, partition_by=[key], inclusive=True, stats=stats)
    return sess.drop("__prev", "__new")


def zip_join(
    routed: DataFrame,
    key: str,
    steps: Sequence[str],
    step: str = "step",
    order: str = "seq",
    ts: str = "time_stamp",
    row_id: str = "event_id",
    group: Sequence[str] = (),
    carry: Sequence[str] = (),
    stats: OrderStats | None = None,
    item_cols: Sequence[str] = (),
) -> DataFrame:
    """The i-th element of every step list per key (and ``group``, e.g. session).

    Output: ``key, *group, n_tuple, <s>_ts, <s>_event`` per step (plus
    ``<s>_<c>`` for every column in ``item_cols``), ``trigger_seq, trigger_ts,
    trigger_event`` (the arrival that completed it) and ``trigger_<c>`` for
    every column in ``carry``.
    """
    parts = [key, *group]
    numbered = row_number(routed, "n_tuple", [order], partition_by=[*parts, step], stats=stats)
    extra = list(dict.fromkeys([*carry, *item_cols]))
    item = F.struct(
        F.col(order).alias("seq"), F.col(ts).alias("ts"), F.col(row_id).alias("id"), *[F.col(c).alias(c) for c in extra]
    )
    per_step = [F.max(F.when(F.col(step) == F.lit(s), item)).alias(s) for s in steps]
    tuples = numbered.groupBy(*parts, "n_tuple").agg(*per_step)
    complete = F.lit(True)
    for s in steps:
        complete = complete & F.col(s).isNotNull()
    trig = F.greatest(*[F.col(s) for s in steps])
    return tuples.where(complete).select(
        *parts,
        F.col("n_tuple").cast("bigint").alias("n_tuple"),
        *[F.col(f"{s}.ts").alias(f"{s}_ts") for s in steps],
        *[F.col(f"{s}.id").alias(f"{s}_event") for s in steps],
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for c in item_cols for s in steps],
        trig["seq"].alias("trigger_seq"),
        trig["ts"].alias("trigger_ts"),
        trig["id"].alias("trigger_event"),
        *[trig[c].alias(f"trigger_{c}") for c in carry],
    )


def pending_sizes(
    df: DataFrame, key: str, routes: Mapping[str, Column], order: str = "seq", prefix: str = "n",
    stats: OrderStats | None = None,
) -> DataFrame:
    """List sizes after each event's add and before its pop (Z3, no expiry).

    ``size_k = count_k(up to and including the event) - tuples emitted before
    the event``, and the tuples emitted before are ``min_k count_k`` at the
    previous event of the key.
    """
    names = list(routes)
    flags = {f"__f{i}": F.when(c, 1).otherwise(0) for i, c in enumerate(routes.values())}
    staged = df.withColumns(flags)
    counts = scan(
        staged, [order], {f"__c{i}": ("sum", F.col(f"__f{i}")) for i in range(len(names))},
        partition_by=[key], inclusive=True, stats=stats,
    )
    before = F.least(*[F.col(f"__c{i}") - F.col(f"__f{i}") for i in range(len(names))])
    out = counts.withColumns(
        {f"{prefix}{i + 1}": (F.col(f"__c{i}") - before).cast("bigint") for i in range(len(names))}
    )
    return out.drop(*flags, *[f"__c{i}" for i in range(len(names))])


def emit_rows(
    tuples: DataFrame, key: str, steps: Sequence[str], group: Sequence[str] = (), carry: Sequence[str] = (),
    item_cols: Sequence[str] = (),
) -> DataFrame:
    """Four output rows per tuple, in step order, stamped with the trigger.

    ``item_cols`` are per-element columns kept by ``zip_join(item_cols=...)``.
    """
    items = F.array(
        *[
            F.struct(
                F.lit(s).alias("step"), F.col(f"{s}_ts").alias("time_stamp"), F.col(f"{s}_event").alias("event_id"),
                *[F.col(f"{s}_{c}").alias(c) for c in item_cols],
            )
            for s in steps
        ]
    )
    trig = ["trigger_seq", "trigger_ts", "trigger_event", *carry]
    return tuples.select(key, *group, "n_tuple", *trig, F.posexplode(items).alias("pos", "item")).select(
        key, *group, "n_tuple", (F.col("pos") + 1).alias("pos"), "item.step", "item.time_stamp", "item.event_id",
        *[f"item.{c}" for c in item_cols], *trig,
    )


# ----------------------------------------------------------------- write TTL
class WriteTtlZip:
    """Sequential semantics of the write-TTL zip for one key (a small helper).

    An element expires when ``written + ttl <= now``.  A pop rewrites the
    survivors of every list, renewing them to ``now``; hence write times never
    decrease along a list and expired elements always form a prefix.
    """

    def __init__(self, n_steps: int, ttl_ms: int):
        self.lists = [deque() for _ in range(n_steps)]  # elements: (written_ms, ts, event_id)
        self.renewed = 0  # time of the last pop; every survivor counts as written then
        self.ttl = ttl_ms
        self.n_out = 0

    def push(self, now: int, ts: int, event_id: int, flags, trigger) -> tuple | None:
        for k, f in enumerate(flags):
            if f:
                self.lists[k].append((now, ts, event_id))
        for lst in self.lists:
            while lst and max(lst[0][0], self.renewed) + self.ttl <= now:
                lst.popleft()
        # what a read sees now: sizes after the add and expiry, before any pop
        self.sizes = tuple(len(lst) for lst in self.lists)
        if not all(self.lists):
            return None
        heads = [lst.popleft() for lst in self.lists]
        self.renewed = now
        self.n_out += 1
        return self.n_out, [(h[1], h[2]) for h in heads], trigger


def _write_ttl_input(df, key, routes, ttl_ms, clock, order, ts, row_id, stats):
    """Rows with step flags, partitioned by (key, gap session) and sorted by arrival."""
    nf = len(routes)
    flagged = df.withColumns({f"__f{i}": c.cast("boolean") for i, c in enumerate(routes.values())})
    sess = gap_sessions(flagged, key, ttl_ms, clock=clock, order=order, stats=stats)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the key passes Python as text: pandas would turn a column with NULLs into doubles
    cols = [F.col(key).cast("string").alias(key), "session", order, clock, ts, row_id] + [f"__f{i}" for i in range(nf)]
    return sess.select(*cols).repartition(n, key, "session").sortWithinPartitions(key, "session", order)


def _fold(batches, key, order, clock, ts, row_id, nf, ttl_ms, emit):
    """Stream sorted batches through one ``WriteTtlZip`` per (key, session)."""
    group, fold = None, None
    for b in batches:
        rows = []
        flags = b[[f"__f{i}" for i in range(nf)]].fillna(False).to_numpy()
        for j, (k, s, q, c, t, e) in enumerate(zip(b[key], b["session"], b[order], b[clock], b[ts], b[row_id])):
            if group != (k, s):
                group, fold = (k, s), WriteTtlZip(nf, ttl_ms)
            hit = fold.push(int(c), int(t), int(e), flags[j], (int(q), int(t), int(e)))
            emit(rows, fold, hit, k, int(s), int(e))
        if rows:
            yield rows


def zip_join_write_ttl(
    df: DataFrame,
    key: str,
    routes: Mapping[str, Column],
    ttl_ms: int,
    clock: str = "clock_ms",
    order: str = "seq",
    ts: str = "time_stamp",
    row_id: str = "event_id",
    stats: OrderStats | None = None,
) -> DataFrame:
    """Zip with a write-refreshed TTL (ST3): sequential fold per (key, gap session).

    A gap of ``ttl`` between arrivals of a key expires every element, so gap
    sessions are independent and are spread over tasks; inside a session the
    fold streams through Spark-sorted Arrow batches holding only the live lists.
    """
    steps = list(routes)
    nf = len(steps)
    part = _write_ttl_input(df, key, routes, ttl_ms, clock, order, ts, row_id, stats)
    key_type = df.schema[key].dataType.simpleString()
    fields = [f"{s}_{x}" for s in steps for x in ("ts", "event")]
    out_cols = [key, "session", "n_tuple", *fields, "trigger_seq", "trigger_ts", "trigger_event"]
    schema = (
        f"{key} string, session bigint, n_tuple bigint, "
        + ", ".join(f"{f} bigint" for f in fields)
        + ", trigger_seq bigint, trigger_ts bigint, trigger_event bigint"
    )

    def emit(rows, fold, hit, k, s, e):
        if hit is not None:
            n_t, items, trig = hit
            rows.append((k, s, n_t, *[v for it in items for v in it], *trig))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _fold(batches, key, order, clock, ts, row_id, nf, ttl_ms, emit):
            yield pd.DataFrame(rows, columns=out_cols)

    return part.mapInPandas(run, schema).withColumn(key, F.col(key).cast(key_type))


def pending_sizes_write_ttl(
    df: DataFrame,
    key: str,
    routes: Mapping[str, Column],
    ttl_ms: int,
    clock: str = "clock_ms",
    order: str = "seq",
    ts: str = "time_stamp",
    row_id: str = "event_id",
    prefix: str = "n",
    stats: OrderStats | None = None,
) -> DataFrame:
    """List sizes per event under the write TTL (Z3 with ST3): after the event's
    add, with expired elements invisible, before its pop."""
    nf = len(routes)
    part = _write_ttl_input(df, key, routes, ttl_ms, clock, order, ts, row_id, stats)
    key_type = df.schema[key].dataType.simpleString()
    names = [f"{prefix}{i + 1}" for i in range(nf)]
    schema = f"{key} string, session bigint, {row_id} bigint, " + ", ".join(f"{n} bigint" for n in names)

    def emit(rows, fold, hit, k, s, e):
        rows.append((k, s, e, *fold.sizes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _fold(batches, key, order, clock, ts, row_id, nf, ttl_ms, emit):
            yield pd.DataFrame(rows, columns=[key, "session", row_id, *names])

    return part.mapInPandas(run, schema).withColumn(key, F.col(key).cast(key_type))
