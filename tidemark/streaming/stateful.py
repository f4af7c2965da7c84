"""Streaming keyed FIFO zip with state by position and expiry (ST1-ST5, Z1-Z3).

``FifoZipProcessor`` is the streaming counterpart of ``operators.zipjoin``.  A key's lists live
in one map state by (step, position) with first and last positions in a value state, so an
event touches the elements that it adds or pops and the heads it looks at, whatever the number
of elements that wait.  Rows of a key are folded one by one in arrival order; what is added and
popped within a batch never reaches the state store.

Expiry is measured on a clock: a column of the rows (``clock``, the running max of event time
that ``WatermarkStamper`` adds), or the time of the micro-batch where it is None.

* ``idle`` (refreshed by any event, ST2): a key's lists are emptied when two of its events are
  ``ttl_ms`` or more apart.
* otherwise (refreshed by writes, ST3): an element expires ``ttl_ms`` after it was added, and a
  pop rewrites, so renews, all that stay.  Expired elements are always the first of their list.

A timer at the last refresh plus ``ttl_ms`` removes the state of keys that never come back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.shared import transform_with_state


class FifoZipProcessor(StatefulProcessor):
    """``item_cols`` are kept per element, ``carry`` columns of the event that completes a tuple.

    With ``sizes`` one row per event comes out instead: the list lengths after its adds and
    expiry, before its pop (Z3).  With ``keep_sessions`` an idle key keeps its session number.
    """

    def __init__(self, steps: Sequence[str], item_schema: str, ttl_ms: int | None = None, content: str = "content",
                 ts: str = "time_stamp", order: str = "seq", row_id: str = "event_id", idle: bool = False,
                 clock: str | None = None, item_cols: Sequence[str] = (), carry: Sequence[str] = (),
                 sizes: bool = False, keep_sessions: bool = False):
        self.steps, self.item_schema, self.ttl_ms = list(steps), item_schema, ttl_ms
        self.content, self.ts, self.order, self.row_id = content, ts, order, row_id
        self.idle, self.clock, self.sizes, self.keep_sessions = idle, clock, sizes, keep_sessions
        self.item_cols, self.carry = list(item_cols), list(carry)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "step int, at long", self.item_schema)
        ends = ", ".join(f"first{k} long, next{k} long" for k in range(len(self.steps)))
        # refreshed: last refresh on the clock; renewed: last pop; n: tuples of the session
        self.ends = handle.getValueState("ends", f"{ends}, n long, session long, refreshed long, renewed long, timer long")

    # ---- one key's state during a batch
    def _load(self) -> None:
        n = len(self.steps)
        row = tuple(self.ends.get()) if self.ends.exists() else (0, 0) * n + (0, 0, None, None, None)
        self.first, self.next = list(row[0 : 2 * n : 2]), list(row[1 : 2 * n : 2])
        self.n, self.session, self.refreshed, self.renewed, self.timer = row[2 * n :]
        self.stored = list(self.next)  # positions from here on are not in the store yet
        self.seen: dict[tuple[int, int], tuple] = {}

    def _peek(self, k: int) -> tuple:
        at = (k, self.first[k])
        if at not in self.seen:
            self.seen[at] = tuple(self.items.getValue(at))
        return self.seen[at]

    def _drop(self, k: int) -> None:
        at = (k, self.first[k])
        self.seen.pop(at, None)
        if self.first[k] < self.stored[k]:
            self.items.removeKey(at)
        self.first[k] += 1

    def _save(self) -> None:
        for k in range(len(self.steps)):
            for at in range(max(self.stored[k], self.first[k]), self.next[k]):
                self.items.updateValue((k, at), self.seen[k, at])
        ends = [x for pair in zip(self.first, self.next) for x in pair]
        self.ends.update((*ends, self.n, self.session, self.refreshed, self.renewed, self.timer))

    def _forget(self) -> None:
        """Every list is empty; positions go on."""
        if any(f < s for f, s in zip(self.first, self.stored)):
            self.items.clear()
        self.seen.clear()
        self.first, self.stored = list(self.next), list(self.next)

    def _expire(self, now: int) -> None:
        if self.idle:
            if self.refreshed is None or now - self.refreshed >= self.ttl_ms:
                self._forget()
                self.n, self.session = 0, self.session + 1
            return
        for k in range(len(self.steps)):
            while self.first[k] < self.next[k]:
                written = self._peek(k)[0]
                if max(written, self.renewed if self.renewed is not None else written) + self.ttl_ms > now:
                    break
                self._drop(k)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self._load()
        batch_ms = timerValues.getCurrentProcessingTimeInMs()
        for r in sorted(rows, key=lambda r: r[self.order]):
            now = r[self.clock] if self.clock else batch_ms
            content, wrote = r[self.content], False
            if self.ttl_ms is not None and self.idle:
                self._expire(now)  # a gap empties the lists before the event adds to them
            for k, s in enumerate(self.steps):
                if content is not None and s in content:
                    self.seen[k, self.next[k]] = (now, r[self.ts], r[self.row_id], r[self.order], *(r[c] for c in self.item_cols))
                    self.next[k] += 1
                    wrote = True
            if self.ttl_ms is not None and not self.idle:
                self._expire(now)
            if self.sizes:
                n = {f"n{k + 1}": b - a for k, (a, b) in enumerate(zip(self.first, self.next))}
                yield Row(key=key[0], event_id=r[self.row_id], **n)
            if all(a < b for a, b in zip(self.first, self.next)):
                heads = [self._peek(k) for k in range(len(self.steps))]
                for k in range(len(self.steps)):
                    self._drop(k)
                self.n, self.renewed, wrote = self.n + 1, now, True
                if not self.sizes:
                    yield self._tuple(key[0], heads, r)
            if wrote or self.idle:
                self.refreshed = now
        if self.ttl_ms is not None and self.timer is None and self.refreshed is not None:
            self.timer = self.refreshed + self.ttl_ms
            self.handle.registerTimer(self.timer)
        self._save()

    def _tuple(self, key, heads: list[tuple], r: Row) -> Row:
        out = {"key": key, "session": self.session, "n_tuple": self.n}
        for s, h in zip(self.steps, heads):
            out[f"{s}_ts"], out[f"{s}_event"] = h[1], h[2]
            out |= {f"{s}_{c}": v for c, v in zip(self.item_cols, h[4:])}
        out |= {"trigger_seq": r[self.order], "trigger_ts": r[self.ts], "trigger_event": r[self.row_id]}
        return Row(**out, **{f"trigger_{c}": r[c] for c in self.carry})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.refreshed is not None and self.refreshed + self.ttl_ms > due:
            self.timer = self.refreshed + self.ttl_ms  # refreshed meanwhile: look again then
            self.handle.registerTimer(self.timer)
            self._save()
        elif self.keep_sessions:
            self._forget()
            self.timer = None
            self._save()
        else:
            self.items.clear()
            self.ends.clear()
        return iter([])

    def close(self) -> None:
        pass


def _fields(df: DataFrame, cols: Sequence[str], prefix: str = "") -> str:
    return "".join(f", {prefix}{c} {df.schema[c].dataType.simpleString()}" for c in cols)


def _processor(events: DataFrame, steps: Sequence[str], **kw) -> FifoZipProcessor:
    ts, row_id, order = (kw.get(n) or d for n, d in (("ts", "time_stamp"), ("row_id", "event_id"), ("order", "seq")))
    item = f"written long{_fields(events, [ts, row_id, order])}{_fields(events, kw.get('item_cols') or ())}"
    return FifoZipProcessor(steps, item, **kw)


def _apply(events: DataFrame, key: str, processor: FifoZipProcessor, schema: str) -> DataFrame:
    mode = "None" if processor.ttl_ms is None else "EventTime" if processor.clock else "ProcessingTime"
    return transform_with_state(events, [key], processor, schema, mode).withColumnRenamed("key", key)


def zip_stream(events: DataFrame, key: str, steps: Sequence[str], ttl_ms: int | None = None, idle: bool = False,
               clock: str | None = None, item_cols: Sequence[str] = (), carry: Sequence[str] = (),
               keep_sessions: bool = False, ts: str = "time_stamp", order: str = "seq", row_id: str = "event_id") -> DataFrame:
    """The i-th element of every step list per key of a stream (append mode), as ``zip_join``.

    ``ttl_ms`` counts from the last write or pop, with ``idle`` from the key's last event.  With
    ``clock`` the stream needs a watermark (``stamped_stream`` has it).  Needs the RocksDB state
    store provider (map state and timers), as ``replay.run_available`` and ``session.local_session`` set it.
    """
    processor = _processor(events, steps, ttl_ms=ttl_ms, idle=idle, clock=clock, item_cols=item_cols, carry=carry,
                           keep_sessions=keep_sessions, ts=ts, order=order, row_id=row_id)
    of = {n: events.schema[n].dataType.simpleString() for n in (key, ts, order, row_id)}
    schema = f"key {of[key]}, session long, n_tuple long"
    for s in steps:
        schema += f", {s}_ts {of[ts]}, {s}_event {of[row_id]}" + _fields(events, item_cols, f"{s}_")
    schema += f", trigger_seq {of[order]}, trigger_ts {of[ts]}, trigger_event {of[row_id]}" + _fields(events, carry, "trigger_")
    out = _apply(events, key, processor, schema)
    return out if idle else out.drop("session")


def pending_sizes_stream(events: DataFrame, key: str, steps: Sequence[str], ttl_ms: int | None = None,
                         idle: bool = False, clock: str | None = None, ts: str = "time_stamp", order: str = "seq",
                         row_id: str = "event_id") -> DataFrame:
    """List lengths per event of a stream (Z3), with the same expiry as ``zip_stream``."""
    processor = _processor(events, steps, ttl_ms=ttl_ms, idle=idle, clock=clock, sizes=True, ts=ts, order=order, row_id=row_id)
    of = {n: events.schema[n].dataType.simpleString() for n in (key, row_id)}
    schema = f"key {of[key]}, event_id {of[row_id]}, " + ", ".join(f"n{k + 1} long" for k in range(len(steps)))
    return _apply(events, key, processor, schema).withColumnRenamed("event_id", row_id)
