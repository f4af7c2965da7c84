"""Restaurants of word contexts (8): the levels of the Pitman-Yor model above its classes.

    P(w | class, u, v)          two words before and the class of the third
        parent P(w | class, class, v)      one word before and the classes of the two before it
            parent H(w | three classes)    the model of classes, their base

A context's parent is a function of it, as u and v determine their classes.  ``H`` is fitted to
all training tokens and stays fixed; between the word levels every table sends a customer to
the parent.  Seatings are sampled by Gibbs and the predictive probabilities of ``SAMPLES``
seatings averaged; a word's gain is log10 of P over H, so a text's score is that of the classes
plus its gains, and contexts that training has not seen add nothing.

Events (contexts and the word that follows) of all texts are packed in chunks, sorted by the
parent context's hash and dealt by ranges of it, one part to about ``EVENTS`` events, so a part
holds its restaurants whole and their children with them.  A part counts the training
events, estimates the discount of its two levels (n1 / (n1 + 2 n2) of their dishes), seats and
scores, and returns one sum a row and chunk.  Texts are not shuffled; nothing is kept that
grows with the input in one place.  A parent context is a word and two classes, so even
the commonest word's events are dealt to many parts.

Dishes are the end, the words of the head, and per class one for all rarer and new
words: what a rare word has of its own within that dish is in the score of the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.seating import seat
from tidemark.llm.textbytes import mix, random_odd

#: Events of a chunk, and of one part of the contexts; rows of a chunk.
CHUNK_EVENTS = 1 << 20
EVENTS = 1 << 19
ROWS = 1 << 16
#: Bits of the classes in a context's number; a word's code has the rest.
KIND_BITS = 15
#: Codes from here on are hashes of words beyond the head; bits of a code within a parent context.
HASHED, CHILD_BITS = 1 << 48, 40
STRENGTH = 1.0
LEAST_DISCOUNT, MOST_DISCOUNT = 0.05, 0.95
BURN_IN, SAMPLES = 5, 5
#: Kinds of packed data: events of a part, the rows of a chunk, gains of a chunk's rows.
OF_EVENTS, OF_ROWS, OF_GAINS = 0, 1, 2
PACKED = "part int, chunk long, kind int, data binary"
GAINED = "chunk long, kind int, data binary"

#: Training rows, contexts (differences), their events' number, words two before, dishes, rows.
EVENT_FIELDS = ("<u2", "u1", "u1", "u1", "u1", "<u2")
ROW_FIELDS, GAIN_FIELDS = ("<i8", "<i4"), ("<f4", "u1")
_ODD = random_odd(6, 8)
_BACK = np.uint64(pow(int(_ODD[0]), -1, 1 << 64))


class Dishes(NamedTuple):
    """Hashes of the head's words (sorted), their ranks; of all dishes their class and log10 P(dish | class)."""

    keys: np.ndarray
    rank: np.ndarray
    kind: np.ndarray
    word: np.ndarray


def packed(arrays: list[np.ndarray], types: tuple[str, ...]) -> bytes:
    sizes = np.array([len(x) for x in arrays], "<i8")
    return b"".join([sizes.tobytes(), *[x.astype(t).tobytes() for x, t in zip(arrays, types)]])


def unpacked(data: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(data, "<i8", len(types)), 8 * len(types), []
    for n, t in zip(sizes.tolist(), types):
        out.append(np.frombuffer(data, t, n, at))
        at += out[-1].nbytes
    return out


def planes(x: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` low bytes of each number, byte by byte: high ones are mostly zero and compress."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T.ravel()


def from_planes(data: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = data.reshape(n, -1).T
    return out.view("<u8").ravel()


def codes(h: np.ndarray, in_head: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A number for each word, by its rank in the head or its hash; 0 is the end."""
    out = rank + 1
    other = ~in_head
    out[other] = HASHED | (mix(h[other].view(np.uint64) * _ODD[2]) >> np.uint64(16)).view(np.int64)
    return out


def unpacked_events(data: bytes) -> tuple[np.ndarray, ...]:
    """Group, classes, child, dish, whether held out, and row of each event of a chunk in a part."""
    trained, steps, sizes, child, dish, row = unpacked(data, EVENT_FIELDS)
    group = np.repeat(np.cumsum(from_planes(steps, 8), dtype=np.uint64), sizes)
    kinds = (group * _BACK & np.uint64((1 << KIND_BITS) - 1)).astype(np.int64)
    held = row >= int(trained[0]) | int(trained[1]) << 16
    return group, kinds, from_planes(child, CHILD_BITS // 8), from_planes(dish, 3).astype(np.int64), held, row


class Chunk:
    """Collects events of rows; ``add`` and ``flush`` yield PACKED batches of a full chunk."""

    def __init__(self, first: int, parts: int) -> None:
        self.number, self.parts = first, parts
        # where the parts of the hashed contexts begin
        self.edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
        self._clear()

    def _clear(self) -> None:
        self.events, self.rows, self.n_events, self.n_rows = [], [], 0, 0

    def add(self, own, held, piece: int, word, dish, kinds, off, before) -> Iterator[pa.RecordBatch]:
        """Events of the rows ``own``: the ``codes`` of their words and their ``dish``es, ``off`` the rows' offsets.

        ``kinds``: the classes of the three words before, as a number; ``before``: the two words before a
        row that goes on with its ``piece``, latest first.
        """
        for i in range(0, len(own), ROWS):  # mostly one
            j = min(i + ROWS, len(own))
            if self.n_rows + j - i > ROWS:
                yield from self.flush()
            at, sizes = slice(int(off[i]), int(off[j])), np.diff(off[i : j + 1])
            inside = np.arange(at.stop - at.start) - np.repeat(off[i:j] - off[i], sizes)
            v, u = np.zeros((2, at.stop - at.start), np.int64)
            v[1:], u[2:] = word[at][:-1], word[at][:-2]
            v[inside < 1], u[inside < 2] = 0, 0
            if piece:
                v[:1], u[:1], u[1:2] = before[0], before[1], before[0]
            group = (v.view(np.uint64) << np.uint64(KIND_BITS) | kinds[at].astype(np.uint64)) * _ODD[0]
            child = np.where(u < HASHED, u, 1 << (CHILD_BITS - 1) | u & ((1 << (CHILD_BITS - 1)) - 1))
            row = np.repeat(np.arange(self.n_rows, self.n_rows + j - i, dtype=np.uint16), sizes)
            self.events.append((group, child, dish[at].astype(np.uint32), row))
            self.rows.append((own[i:j], np.full(j - i, piece), held[i:j]))
            self.n_rows, self.n_events = self.n_rows + j - i, self.n_events + len(group)
            if self.n_events >= CHUNK_EVENTS:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n_rows:
            return
        own, piece, held = (np.concatenate(x) for x in zip(*self.rows))
        by_fold = np.argsort(held, kind="stable")  # training rows first
        place = np.empty(len(own), np.uint16)
        place[by_fold] = np.arange(len(own))
        trained = int((~held).sum())
        trained = np.array([trained & 0xFFFF, trained >> 16])
        out = [(self.number % self.parts, self.number, OF_ROWS, packed([own[by_fold], piece[by_fold]], ROW_FIELDS))]
        group, child, dish, row = (np.concatenate(x) for x in zip(*self.events))
        self.events = []
        order = np.argsort(group)
        group, child, dish, row = group[order], child[order], dish[order], place[row[order]]
        ends = [0, *np.searchsorted(group, self.edges).tolist(), len(group)]
        for part, (a, b) in enumerate(zip(ends, ends[1:])):
            if a < b:
                # contexts of more than 255 events come several times
                new = np.concatenate([[True], group[a + 1 : b] != group[a : b - 1]])
                starts = np.flatnonzero(new)
                inside = np.arange(b - a) - np.repeat(starts, np.diff(starts, append=b - a))
                starts = np.flatnonzero(inside % 255 == 0)
                steps = np.diff(group[a:b][starts], prepend=np.uint64(0))
                sizes = np.diff(starts, append=b - a)
                arrays = [trained, planes(steps, 8), sizes, planes(child[a:b], CHILD_BITS // 8), planes(dish[a:b], 3), row[a:b]]
                out.append((part, self.number, OF_EVENTS, packed(arrays, EVENT_FIELDS)))
        types = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["part", "chunk", "kind", "data"])
        self.number += 1
        self._clear()


def discount(n: np.ndarray) -> float:
    once, twice = (n == 1).sum(), (n == 2).sum()
    return float(np.clip(once / max(once + 2 * twice, 1), LEAST_DISCOUNT, MOST_DISCOUNT))


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and each key's number."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def seated_gains(group, child, dish, held, base, seed: int) -> np.ndarray:
    """log10 of P over ``base`` of each event, by the restaurants of the events that are not ``held``.

    ``group``, ``child``: the parent context and what makes the context of it; ``base``: H of the dish.
    """
    rng = np.random.default_rng(seed)
    served = dish.astype(np.uint64) + np.uint64(1)
    context = mix(group ^ child * _ODD[3])
    at, of = numbered(mix(context ^ served * _ODD[4]))  # dishes of contexts, of each event
    up_at, up_of = numbered(mix(group ^ served * _ODD[5]))  # dishes of parents
    up = up_of[at]
    _, room = numbered(context[at])  # the restaurant of each dish
    _, up_room = numbered(group[up_at])
    base = base[up_at]
    n = np.bincount(of, ~held).astype(float)
    up_first = np.bincount(up, n > 0, len(up_at))
    d, up_d = discount(n), discount(up_first)
    rooms = STRENGTH + np.bincount(room, n)
    # only dishes of several customers can have another number of tables than of customers
    most = np.bincount(up, n, len(up_at))
    some, up_some = np.flatnonzero(n > 1), np.flatnonzero(most > 1)
    place = np.zeros(len(up_at), np.int64)
    place[up_some] = np.arange(len(up_some))
    of_some, room_some, up_room_some = place[up[some]], room[some], up_room[up_some]
    n_some, base_some = n[some], base[up_some]
    tables, up_n, up_tables = np.minimum(n, 1), up_first, np.minimum(up_first, 1)
    sent = np.bincount(up, n == 1, len(up_at))[up_some]  # by dishes of one customer
    fixed, up_fixed = np.bincount(room, n == 1), np.bincount(up_room, most == 1)
    add = lambda rest, rooms, x: rest + np.bincount(rooms, x, len(rest))
    # where the tables of a room are fixed, P is linear in its parent's
    loose = np.zeros(len(fixed), bool)
    loose[room_some] = True
    loose = np.flatnonzero(loose[room])
    n_loose, room_loose, up_loose = n[loose], room[loose], up[loose]
    parents, mean_loose = np.zeros(len(up_at)), np.zeros(len(loose))
    up_weight = STRENGTH + up_d * add(up_fixed, up_room_some, up_tables[up_some])
    for sweep in range(BURN_IN + SAMPLES):
        parent = np.maximum(up_n[up_some] - up_d * up_tables[up_some], 0) + up_weight[up_room_some] * base_some
        parent /= (STRENGTH + add(up_fixed, up_room_some, up_n[up_some]))[up_room_some]
        weight = STRENGTH + d * add(fixed, room_some, tables[some])
        tables[some] = seat(n_some, weight[room_some] * parent[of_some], d, rng)
        up_n[up_some] = sent + np.bincount(of_some, tables[some], len(up_some))
        up_tables[up_some] = seat(up_n[up_some], up_weight[up_room_some] * base_some, up_d, rng)
        up_weight = STRENGTH + up_d * add(up_fixed, up_room_some, up_tables[up_some])
        if sweep >= BURN_IN:
            up_rooms = STRENGTH + add(up_fixed, up_room_some, up_n[up_some])
            parent = (np.maximum(up_n - up_d * up_tables, 0) + up_weight[up_room] * base) / up_rooms[up_room]
            parents += parent
            weight = (STRENGTH + d * add(fixed, room_some, tables[some])) / rooms
            mean_loose += np.maximum(n_loose - d * tables[loose], 0) / rooms[room_loose] + weight[room_loose] * parent[up_loose]
    weight = (STRENGTH + d * fixed) / rooms
    mean = np.maximum(n - d * tables, 0) / rooms[room] + weight[room] * (parents / SAMPLES)[up]
    mean[loose] = mean_loose / SAMPLES
    return np.log10(mean / base[up])[of]


def gains(events: DataFrame, served: Dishes, grams: np.ndarray, bits: int) -> DataFrame:
    """(own, gain) of PACKED ``events``; ``grams``: log10 P(class | three before) by their number of ``bits`` a class."""
    shared = events.sparkSession.sparkContext.broadcast((served.kind, served.word, grams))

    def of_part(table: pa.Table) -> pa.Table:
        kind, word, grams = shared.value
        part, chunks, sorts, data = (table.column(c).to_pylist() for c in ("part", "chunk", "kind", "data"))
        out = [(c, k, x) for c, k, x in zip(chunks, sorts, data) if k == OF_ROWS]
        own = [(c, unpacked_events(x)) for c, k, x in zip(chunks, sorts, data) if k == OF_EVENTS]
        if own:
            group, kinds, child, dish, held = (np.concatenate(x) for x in list(zip(*[x for _, x in own]))[:5])
            base = 10 ** (grams[kinds << bits | kind[dish]] + word[dish])
            gain, at = seated_gains(group, child, dish, held, base, part[0]), 0
            for chunk, x in own:
                sums, rows = np.bincount(x[5], gain[at : at + len(x[5])]), np.flatnonzero(np.bincount(x[5]))
                at += len(x[5])
                out.append((chunk, OF_GAINS, packed([sums[rows], planes(np.diff(rows, prepend=0), 2)], GAIN_FIELDS)))
        types = (pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], ["chunk", "kind", "data"])

    def of_chunk(table: pa.Table) -> pa.Table:
        found = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist()))
        own, piece = unpacked(next(x for k, x in found if k == OF_ROWS), ROW_FIELDS)
        gain = np.zeros(len(own))
        for k, x in found:
            if k == OF_GAINS:
                sums, rows = unpacked(x, GAIN_FIELDS)
                gain[np.cumsum(from_planes(rows, 2)).astype(np.int64)] += sums
        return pa.table([pa.array(own), pa.array(piece), pa.array(gain)], ["own", "piece", "gain"])

    by_chunk = events.groupBy("part").applyInArrow(of_part, GAINED)
    rows = by_chunk.groupBy("chunk").applyInArrow(of_chunk, "own long, piece int, gain double")
    # rows of one doc_id and text have the same gains
    once = rows.groupBy("own", "piece").agg(F.max("gain").alias("gain"))
    return once.groupBy("own").agg(F.sum("gain").alias("gain"))
