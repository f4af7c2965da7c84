"""Streaming sequence matching per key in event-time order (C1-C7 on streams).

Rows wait in a map state by event time until the watermark passes them; the timer of a time
reads the rows of that time only (C7).  They advance the key's partial matches in (event time,
``order``): a partial waiting for step k takes the first later row that satisfies step k
(relaxed contiguity), and every row that satisfies step 1 starts a new partial.

All partials that wait for the same step go on together, so they are one linked list, known by
its head.  A row that satisfies their step becomes a node above the whole list and joins the
next list: an event costs the same whether one or a hundred thousand partials wait (C3, C5).
When the last step is met, the tree below its node is walked, one leaf per completed match.

Step conditions are Column expressions that Spark evaluates into a bitmask before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.sequence import SequencePattern
from tidemark.plans.watermark import WatermarkSpec, event_ts
from tidemark.streaming.shared import transform_with_state


class SequenceMatchProcessor(StatefulProcessor):
    """``order`` are the names of the order columns behind the event time, ``payload`` those kept."""

    def __init__(self, names: Sequence[str], order: Sequence[str], payload: Sequence[str], types: Sequence[str]):
        self.names, self.order, self.payload, self.types = list(names), list(order), list(payload), list(types)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kept = ", ".join(f"p{i} {t}" for i, t in enumerate(self.types))
        orders = ", ".join(f"o{i} long" for i in range(len(self.order)))
        self.buffer = handle.getMapState("buffer", "ts long", f"rows array<struct<mask int, {orders}, {kept}>>")
        self.nodes = handle.getMapState("nodes", "id long", f"below long, beside long, {kept}")
        heads = ", ".join(f"h{k} long" for k in range(1, len(self.names)))
        self.heads = handle.getValueState("heads", f"{heads}, last long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, list[tuple]] = {}
        for r in rows:
            item = (r["mask"], *(r[f"o{i}"] for i in range(len(self.order))), *(r[f"p{i}"] for i in range(len(self.types))))
            new.setdefault(r["ts"], []).append(item)
        for ts, items in new.items():
            held = self.buffer.getValue((ts,)) if self.buffer.containsKey((ts,)) else None
            if held is None:
                self.handle.registerTimer(ts)
            self.buffer.updateValue((ts,), ([tuple(x) for x in held[0]] + items if held else items,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ts = expiredTimerInfo.getExpiryTimeInMs()
        held = self.buffer.getValue((ts,))
        self.buffer.removeKey((ts,))
        n = len(self.names)
        heads = list(self.heads.get()) if self.heads.exists() else [0] * n
        head, last = [0, *heads[:-1]], heads[-1]  # head[k]: partials that wait for step k (from 0)
        width = 1 + len(self.order)
        for x in sorted((tuple(x) for x in held[0]), key=lambda x: x[1:width]):
            mask, item = x[0], x[width:]
            for k in range(n - 1, 0, -1):  # later steps first: a row advances a partial once
                if mask >> k & 1 and head[k]:
                    if k == n - 1:
                        yield from self._matches(key, head[k], item)
                    else:
                        last += 1
                        self.nodes.updateValue((last,), (head[k], head[k + 1], *item))
                        head[k + 1] = last
                    head[k] = 0
            if mask & 1:
                last += 1
                self.nodes.updateValue((last,), (0, head[1], *item))
                head[1] = last
        if any(head):
            self.heads.update((*head[1:], last))
        else:
            self.heads.clear()

    def _matches(self, key, at: int, final: tuple) -> Iterator[Row]:
        """One match per leaf below the list ``at``; the nodes are done with."""
        todo = [(at, (final,))]
        while todo:
            at, path = todo.pop()
            below, beside, *item = self.nodes.getValue((at,))
            self.nodes.removeKey((at,))
            if beside:
                todo.append((beside, path))
            path = (tuple(item), *path)
            if below:
                todo.append((below, path))
            else:
                yield Row(key=key[0], **{f"s{k}_{i}": v for k, item in enumerate(path) for i, v in enumerate(item)})

    def close(self) -> None:
        pass


def match_stream(
    events: DataFrame,
    pattern: SequencePattern,
    key: str,
    spec: WatermarkSpec | None = None,
    ts: str = "time_stamp",
    order: Sequence[str] | str = "seq",
    row_id: str = "event_id",
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """Keyed streaming matches: ``key, <step>_<payload>...`` per completed match.

    With ``spec`` the stream gets its watermark here, and Spark drops the rows at or behind it;
    without, ``events`` has one already and late rows were dropped by their stamps.  The payload
    is the row's time and id (``<step>_ts, <step>_event``) unless named.
    """
    order = [order] if isinstance(order, str) else list(order)
    named = list(payload) if payload is not None else [ts, row_id]
    mask = sum((F.when(s.condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, s in enumerate(pattern.steps)), F.lit(0))
    staged = events.select(
        F.col(key).alias("key"), F.col(ts).cast("long").alias("ts"), mask.cast("int").alias("mask"),
        *[F.col(c).cast("long").alias(f"o{i}") for i, c in enumerate(order)],
        *[F.col(c).alias(f"p{i}") for i, c in enumerate(named)],
        *([event_ts(ts).alias("event_ts")] if spec else []),
    )
    if spec:
        staged = staged.withWatermark("event_ts", spec.streaming_delay)
    types = [events.schema[c].dataType.simpleString() for c in named]
    names = [s.name for s in pattern.steps]
    schema = f"key {events.schema[key].dataType.simpleString()}" + "".join(
        f", s{k}_{i} {t}" for k in range(len(names)) for i, t in enumerate(types)
    )
    out = transform_with_state(staged, ["key"], SequenceMatchProcessor(names, order, named, types), schema, "EventTime")
    labels = ["ts", "event"] if payload is None else named
    return out.select(
        F.col("key").alias(key),
        *[F.col(f"s{k}_{i}").alias(f"{n}_{c}") for k, n in enumerate(names) for i, c in enumerate(labels)],
    )
