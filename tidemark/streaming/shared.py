"""Many keys to one row of state: a keyed stateful processor at a cost per row, not per key.

Spark asks a Python processor key by key, and each read, write or timer of its state is a call
to the JVM of its own.  With about as many (key, window) groups as rows these calls are nearly
the whole time of a query.  ``transform_with_state`` deals the keys into ``SHARES`` shares, and
Spark's grouping key is the share.  ``SharedProcessor`` runs an ordinary per-key processor for
every key of a share, with a handle whose states and timers live in Python:

* A share's keys lie in pages (by a hash of the key), one pickled value each.  A batch reads and
  writes the pages of its own keys once.  When a page outgrows ``PAGE_BYTES`` the share's pages
  are doubled, so what a key costs does not grow with the number of keys.
* A list or map of one key beyond ``FAR_ITEMS`` elements leaves the page for a map state of its
  own, entry by entry: a hot key's elements that an event does not look at are not touched.
* Spark holds one timer per share, at the earliest of its keys' timers; when it is due, the pages
  with due timers are read and each key's timers run in ascending order.
* Plain columns travel as data frames, not cell by cell; a bit mask says which values are NULL, so
  integers stay exact and NaN is not NULL.  ``inner`` gets each row as a mapping by column name.

Rows of a share within a micro-batch are held in memory (as those of a key are by the processors
that sort them): bound them by the source's rate.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    FractionalType,
    IntegralType,
    StringType,
    StructType,
    TimestampNTZType,
)

#: Shares of the keys: the most tasks that a stateful operator can use.
SHARES = 1024
PAGE_BYTES = 1 << 20
FAR_ITEMS = 1 << 14
#: Elements of a far list that are kept as one entry.
FAR_CHUNK = 1 << 10
_SHARE = "__share"
#: Key types whose Python values are equal exactly if Spark groups them together.
_EXACT = (StringType, IntegralType, BooleanType, BinaryType, DateType, DecimalType, TimestampNTZType)


_NULLS = "nulls"
#: Rows of a data frame that is returned.
FRAME_ROWS = 10_000


def _plain(schema: StructType) -> bool:
    """Whether all columns have types that data frames hold exactly."""
    kinds = (IntegralType, FractionalType, BooleanType, StringType)
    return len(schema) < 63 and all(isinstance(f.dataType, kinds) and not isinstance(f.dataType, DecimalType) for f in schema)


def _dumps(value) -> bytes:
    return pickle.dumps(value, pickle.HIGHEST_PROTOCOL)


class _Value:
    """A value state of the key at hand."""

    def __init__(self, owner: SharedProcessor, name: str):
        self.owner, self.name = owner, name

    def exists(self) -> bool:
        return self.name in self.owner.states

    def get(self):
        return self.owner.states.get(self.name)

    def update(self, value) -> None:
        self.owner.states[self.name] = tuple(value)

    def clear(self) -> None:
        self.owner.states.pop(self.name, None)


class _Map:
    """A map state of the key at hand: a dict, or (number in the far map, 0) when it is large."""

    def __init__(self, owner: SharedProcessor, name: str):
        self.owner, self.name = owner, name

    def _near(self):
        return self.owner.states.get(self.name, {})

    def exists(self) -> bool:
        near = self._near()
        return any(True for _ in self.owner.far_keys(near[0])) if isinstance(near, tuple) else bool(near)

    def getValue(self, key):
        near = self._near()
        return self.owner.far_get(near[0], _dumps(tuple(key))) if isinstance(near, tuple) else near.get(tuple(key))

    def containsKey(self, key) -> bool:
        near = self._near()
        return self.owner.far.containsKey((near[0], _dumps(tuple(key)))) if isinstance(near, tuple) else tuple(key) in near

    def updateValue(self, key, value) -> None:
        near = self.owner.states.setdefault(self.name, {})
        if isinstance(near, tuple):
            self.owner.far.updateValue((near[0], _dumps(tuple(key))), (_dumps(tuple(value)),))
        else:
            near[tuple(key)] = tuple(value)

    def removeKey(self, key) -> None:
        near = self._near()
        if isinstance(near, tuple):
            self.owner.far.removeKey((near[0], _dumps(tuple(key))))
        elif tuple(key) in near:
            del near[tuple(key)]
            if not near:
                del self.owner.states[self.name]

    def clear(self) -> None:
        self.owner.drop(self.name)


class _List:
    """A list state of the key at hand: a list, or (number in the far map, chunks) when it is long."""

    def __init__(self, owner: SharedProcessor, name: str):
        self.owner, self.name = owner, name

    def exists(self) -> bool:
        return self.name in self.owner.states

    def get(self) -> Iterator[tuple]:
        near = self.owner.states.get(self.name, [])
        if not isinstance(near, tuple):
            return iter(near)
        return (x for k in range(near[1]) for x in self.owner.far_get(near[0], _dumps(k)))

    def appendList(self, items) -> None:
        near = self.owner.states.setdefault(self.name, [])
        if isinstance(near, tuple):
            self.owner.states[self.name] = self.owner.far_append(near, items)
        else:
            near.extend(items)

    def appendValue(self, item) -> None:
        self.appendList([tuple(item)])

    def clear(self) -> None:
        self.owner.drop(self.name)


class SharedProcessor(StatefulProcessor):
    """``inner`` for every key (columns ``keys``) of a share; it is its own handle to ``inner``."""

    def __init__(self, inner: StatefulProcessor, keys: Sequence[str]):
        self.inner, self.keys = inner, list(keys)
        self.page_bytes, self.far_items = PAGE_BYTES, FAR_ITEMS  # go to the workers with the processor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "kept binary")
        self.pages = handle.getMapState("pages", "page int", "kept binary")
        self.far = handle.getMapState("far", "id long, at binary", "kept binary")
        self.states, self.timers, self.queue = {}, set(), None
        self.inner.init(self)

    # ---- the handle that ``inner`` gets
    def getValueState(self, name: str, *_) -> _Value:
        return _Value(self, name)

    def getMapState(self, name: str, *_) -> _Map:
        return _Map(self, name)

    def getListState(self, name: str, *_) -> _List:
        return _List(self, name)

    def registerTimer(self, at: int) -> None:
        if at not in self.timers:
            self.timers.add(at)
            if self.queue is not None:
                heapq.heappush(self.queue, at)

    def deleteTimer(self, at: int) -> None:
        self.timers.discard(at)

    # ---- large lists and maps
    def far_get(self, id: int, at: bytes):
        kept = self.far.getValue((id, at))
        return None if kept is None else pickle.loads(kept[0])

    def far_keys(self, id: int) -> Iterator[tuple]:
        return (k for k in self.far.keys() if k[0] == id)

    def far_append(self, near: tuple[int, int], items) -> tuple[int, int]:
        items, (id, chunks) = list(items), near
        for k in range(0, len(items), FAR_CHUNK):
            self.far.updateValue((id, _dumps(chunks)), (_dumps(items[k : k + FAR_CHUNK]),))
            chunks += 1
        return id, chunks

    def drop(self, name: str) -> None:
        gone = self.states.pop(name, None)
        if isinstance(gone, tuple):
            for k in list(self.far_keys(gone[0])):
                self.far.removeKey(tuple(k))

    def _move_far(self) -> None:
        for name, kept in self.states.items():
            if isinstance(kept, (list, dict)) and len(kept) > self.far_items:
                at = self.states[name] = (self.next_far, 0)
                self.next_far += 1
                if isinstance(kept, list):
                    self.states[name] = self.far_append(at, kept)
                else:
                    for k, v in kept.items():
                        self.far.updateValue((at[0], _dumps(k)), (_dumps(v),))

    # ---- pages of a share
    def _open(self) -> None:
        """``due``: the earliest timer of each page that has one; ``armed``: Spark's timer of the share."""
        self.bits, self.next_far, self.armed, self.due = pickle.loads(self.meta.get()[0]) if self.meta.exists() else (0, 0, None, {})

    def _close(self, passed: int | None = None) -> None:
        first = min(self.due.values(), default=None)
        if first is not None and (self.armed is None or first < self.armed):
            if self.armed is not None:
                self.handle.deleteTimer(self.armed)
            self.handle.registerTimer(first)
            self.armed = first
        self.meta.update((_dumps((self.bits, self.next_far, self.armed, self.due)),))

    def _page(self, key: tuple) -> int:
        return zlib.crc32(repr(key).encode()) & ((1 << self.bits) - 1)

    def _load(self, page: int) -> dict:
        kept = self.pages.getValue((page,)) if self.pages.containsKey((page,)) else None
        return {} if kept is None else pickle.loads(kept[0])

    def _store(self, page: int, kept: dict) -> bool:
        """Whether the share's pages should be doubled."""
        first = min((min(timers) for _, timers in kept.values() if timers), default=None)
        if first is None:
            self.due.pop(page, None)
        else:
            self.due[page] = first
        if not kept:
            self.pages.removeKey((page,))
            return False
        data = _dumps(kept)
        self.pages.updateValue((page,), (data,))
        return len(data) > self.page_bytes and len(kept) > 1 and self.bits < 20

    def _double(self) -> None:
        old = 1 << self.bits
        self.bits += 1
        for page in range(old):
            kept = self._load(page)
            if kept:
                for at in (page, page + old):
                    self._store(at, {k: v for k, v in kept.items() if self._page(k) == at})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        of: dict[tuple, list] = {}
        for r in rows:
            of.setdefault(tuple([r[k] for k in self.keys]), []).append(r)
        self._open()
        pages: dict[int, list[tuple]] = {}
        for k in of:
            pages.setdefault(self._page(k), []).append(k)
        full = False
        for page, keys in pages.items():
            kept = self._load(page)
            for k in keys:
                self.states, self.timers = kept.pop(k, None) or ({}, set())
                yield from self.inner.handleInputRows(k, iter(of.pop(k)), timerValues)
                self._keep(kept, k)
            full |= self._store(page, kept)
        if full:
            self._double()
        self._close()

    def _keep(self, kept: dict, k: tuple) -> None:
        if self.states or self.timers:
            self._move_far()
            kept[k] = self.states, self.timers

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        until = expiredTimerInfo.getExpiryTimeInMs()
        self._open()
        self.armed = None
        # Spark's own timers are due below the watermark, or the time of the batch without one
        now = self._now(timerValues)
        until = until if now is None else max(until, now - 1)
        for page in sorted(p for p, first in self.due.items() if first <= until):
            kept = self._load(page)
            for k in [k for k, (_, timers) in kept.items() if timers and min(timers) <= until]:
                self.states, self.timers = kept.pop(k)
                self.queue = [t for t in self.timers if t <= until]
                heapq.heapify(self.queue)
                while self.queue and self.queue[0] <= until:
                    at = heapq.heappop(self.queue)
                    if at in self.timers:
                        self.timers.discard(at)
                        yield from self.inner.handleExpiredTimer(k, timerValues, ExpiredTimerInfo(at))
                self.queue = None
                self._keep(kept, k)
            self._store(page, kept)
        self._close()

    def close(self) -> None:
        self.inner.close()


class EventTimeShared(SharedProcessor):
    @staticmethod
    def _now(timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs()


class ProcessingTimeShared(SharedProcessor):
    @staticmethod
    def _now(timerValues) -> int:
        return timerValues.getCurrentProcessingTimeInMs()


class FrameProcessor(StatefulProcessor):
    """``shared`` between data frames: columns ``names`` and the NULL mask in, ``out`` out."""

    def __init__(self, shared: SharedProcessor, names: Sequence[str], out: StructType):
        self.shared, self.names, self.out, self.frame_rows = shared, list(names), out, FRAME_ROWS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shared.init(handle)

    def _rows(self, frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for frame in frames:
            cols = [frame[f"c{i}"].tolist() for i in range(len(self.names))]
            nulls = frame[_NULLS].to_numpy()
            for i, values in enumerate(cols):
                for at in (nulls >> i & 1).nonzero()[0].tolist():
                    values[at] = None
            for values in zip(*cols):
                yield dict(zip(self.names, values))

    def _frames(self, rows: Iterator[Row]) -> Iterator[pd.DataFrame]:
        held, at = [], None
        for r in rows:
            at = at or [r.__fields__.index(f.name) for f in self.out]
            held.append(tuple(r))
            if len(held) >= self.frame_rows:
                yield self._frame(held, at)
                held = []
        if held:
            yield self._frame(held, at)

    def _frame(self, rows: list[tuple], at: list[int]) -> pd.DataFrame:
        cols = list(zip(*rows))
        arrays = {f.name: pa.array(cols[i], to_arrow_type(f.dataType)) for i, f in zip(at, self.out)}
        return pd.DataFrame({n: pd.Series(pd.arrays.ArrowExtensionArray(a)) for n, a in arrays.items()})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        return self._frames(self.shared.handleInputRows(key, self._rows(rows), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._frames(self.shared.handleExpiredTimer(key, timerValues, expiredTimerInfo))

    def close(self) -> None:
        self.shared.close()


def _framed(rows: DataFrame) -> DataFrame:
    """``rows`` as columns ``c0``, ``c1``, ... without NULL, and the mask of what was NULL."""
    mask, cols = F.lit(0).cast("long"), []
    for i, f in enumerate(rows.schema):
        c = F.col(f.name)
        zero = F.lit("") if isinstance(f.dataType, StringType) else F.lit(0).cast(f.dataType)
        mask = mask.bitwiseOR(F.when(c.isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
        cols.append(F.coalesce(c, zero).alias(f"c{i}"))
    return rows.select(*cols, mask.alias(_NULLS))


def transform_with_state(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: StructType | str,
                         time_mode: str) -> DataFrame:
    """``rows.groupBy(*keys).transformWithState(processor)`` in append mode, with shared rows of state."""
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kw = {"outputStructType": out, "outputMode": "Append", "timeMode": time_mode}
    if not all(isinstance(rows.schema[k].dataType, _EXACT) for k in keys):
        return rows.groupBy(*keys).transformWithState(processor, **kw)
    processor = (ProcessingTimeShared if time_mode == "ProcessingTime" else EventTimeShared)(processor, keys)
    share = F.pmod(F.hash(*keys), F.lit(SHARES)).alias(_SHARE)
    if not (_plain(rows.schema) and _plain(out)):
        return rows.select("*", share).groupBy(_SHARE).transformWithState(processor, **kw)
    framed = _framed(rows.select("*", share)).withColumnRenamed(f"c{len(rows.columns)}", _SHARE)
    return framed.groupBy(_SHARE).transformWithStateInPandas(FrameProcessor(processor, rows.columns, out), **kw)
