"""Sequence pattern matching with relaxed contiguity.

``begin("step1", p1).followed_by("step2", p2)...`` matches, for every row that
satisfies the first condition, the next row satisfying the second condition,
then the next row after that satisfying the third, and so on (skip-till-next,
no skip strategy: every start row yields at most one match).

Spark formulation: chain the steps backwards.  For the last step let ``c_n`` be
the row itself when it satisfies ``p_n``; "the next such row after me" is the
minimum of ``c_n`` over the following rows (structs compare by their leading
order fields).  Step ``k`` then carries its successor:
``c_k = struct(row, next_{k+1})`` when ``p_k``.  Each step is one suffix scan
(``plans.scan``: bucketed, skew-safe, also for the global non-keyed form), so a
pattern of n steps costs n-1 scans and never collects a key or the stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.lineage import cut
from tidemark.plans.ordinal import with_ordinal
from tidemark.plans.scan import OrderStats, lead_is_balanced, needs_buckets, order_stats, scan


# Global chains keep one bucket column across their scans (one shuffle of the rows).
SHARE_BUCKETS = True
# Column of the dense order when the given one is ranked first.
RANK = "__ord"


@dataclass(frozen=True)
class Step:
    name: str
    condition: Column


@dataclass(frozen=True)
class SequencePattern:
    """A chain of named steps joined by relaxed contiguity (``followedBy``)."""

    steps: tuple[Step, ...] = field(default_factory=tuple)

    @staticmethod
    def begin(name: str, where: Column) -> SequencePattern:
        return SequencePattern((Step(name, where),))

    def followed_by(self, name: str, where: Column) -> SequencePattern:
        if any(s.name == name for s in self.steps):
            raise ValueError(f"duplicate step name {name!r}")
        return SequencePattern(self.steps + (Step(name, where),))

    @property
    def names(self) -> list[str]:
        return [s.name for s in self.steps]


def drop_late(df: DataFrame, ts: str = "time_stamp", wm: str = "wm_ms") -> DataFrame:
    """Event-time operators ignore rows at or behind the watermark."""
    return df.where(F.col(wm).isNull() | (F.col(ts) > F.col(wm)))


def match_sequence(
    df: DataFrame,
    pattern: SequencePattern,
    order: Sequence[str] = ("time_stamp", "seq"),
    partition_by: Sequence[str] | None = None,
    payload: Sequence[str] = ("time_stamp", "event_id"),
    stats: OrderStats | None = None,
) -> DataFrame:
    """One row per completed match: ``*partition_by, <step>_<payload>...``.

    ``order`` is a total order (event time, then arrival).  ``partition_by``
    None matches over the whole stream, as a non-keyed pattern does.
    """
    keys = list(partition_by or [])
    order = list(order)
    steps = list(pattern.steps)
    if len(steps) < 2:
        raise ValueError("a sequence pattern needs at least two steps")
    fields = list(dict.fromkeys(order + list(payload)))
    if stats is None:
        stats = order_stats(df, order[0])
    buckets = needs_buckets(stats, keyed=bool(keys), df=df)
    # check the lead once for all steps; rank only if a bucket would overfill a task
    balanced = order == [RANK] or not buckets or lead_is_balanced(df, order[0], keys, stats, unique=len(order) == 1)
    if not balanced:
        ranked = with_ordinal(df, order, RANK)
        dense = replace(order_stats(ranked, RANK), hot=stats.hot)
        return match_sequence(ranked, pattern, [RANK], partition_by, payload, dense)

    def item(extra: Column | None) -> Column:
        cols = [F.col(c).alias(c) for c in fields]
        if extra is not None:
            cols.append(extra.alias("next"))
        return F.struct(*cols)

    cur = df
    nxt: str | None = None
    # a global chain keeps one bucket column so only its first scan shuffles the rows
    share = "__mb" if SHARE_BUCKETS and not keys and buckets else None
    for k in range(len(steps) - 1, 0, -1):
        c_k = F.when(steps[k].condition, item(F.col(nxt) if nxt else None))
        name = f"__next{k}"
        cur = scan(cur, order, {name: ("min", c_k)}, partition_by=keys, following=True, stats=stats, balanced=balanced,
                   bucket=share)
        if nxt:
            cur = cur.drop(nxt)
        nxt = name
        if keys and buckets and k > 1:
            # a bucketed scan reads its input twice: the plan stays linear in the steps
            cur = cut(cur, "match-step")
    complete = steps[0].condition & F.col(nxt).isNotNull()
    path = [F.col(nxt)]
    for _ in range(len(steps) - 2):
        complete = complete & path[-1]["next"].isNotNull()
        path.append(path[-1]["next"])
    matched = cur.where(complete)
    out = [F.col(k) for k in keys]
    out += [F.col(p).alias(f"{steps[0].name}_{p}") for p in payload]
    for st, node in zip(steps[1:], path):
        out += [node[p].alias(f"{st.name}_{p}") for p in payload]
    return matched.select(*out)


def select_process_data(
    matches: DataFrame, names: Sequence[str], keys: Sequence[str] = (), ts: str = "time_stamp"
) -> DataFrame:
    """The select function (C6): ``(name, time)`` per step plus the event count."""
    cols = [F.col(k) for k in keys]
    for n in names:
        cols += [F.lit(n).alias(f"{n}_name"), F.col(f"{n}_{ts}").alias(f"{n}_ts")]
    # every step holds exactly one event under followedBy without quantifiers
    n_events = sum((F.when(F.col(f"{n}_{ts}").isNotNull(), 1).otherwise(0) for n in names), F.lit(0))
    return matches.select(*cols, n_events.cast("bigint").alias("n_events"))
