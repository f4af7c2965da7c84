"""Words and word hashes of Arrow text columns, computed on their UTF-8 bytes.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z count as
a-z.  Everything is vectorised over small groups of documents (about
``GROUP_BYTES``), so memory stays bounded for any batch; one very long text is
worked off in pieces that end at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20
SEED = 20_241
_MIX1, _MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply); returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(_MIX1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX2)
    x ^= x >> np.uint64(31)
    return x


def random_odd(n: int, stream: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    start = np.uint64(SEED + stream * 1_000_003) + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(start) | np.uint64(1)


class Hasher:
    """Hashes of the words of byte strings; keeps its power tables."""

    def __init__(self) -> None:
        table = mix(np.arange(256, dtype=np.uint64) + np.uint64(SEED))
        table[65:91] = table[97:123]
        space = np.zeros(256, dtype=bool)
        space[[32, 9, 10, 11, 12, 13]] = True
        table[space] = 0
        self.table, self.space = table, space
        self.base = 0xD1342543DE82EF95
        self.inverse = pow(self.base, -1, 1 << 64)
        self._powers(GROUP_BYTES + 1)

    def _powers(self, n: int) -> None:
        self.pow = np.cumprod(np.full(n, self.base, dtype=np.uint64))
        self.inv = np.cumprod(np.full(n, self.inverse, dtype=np.uint64))

    def words(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first and last byte of each word; a word never crosses a position in ``breaks``."""
        n = len(data)
        if n == 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        if n > len(self.pow):
            self._powers(n)
        inside = ~self.space[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[breaks] = True
        edge[0] = edge[n] = True
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[0], before[1:] = True, ~inside[:-1]
        after[-1], after[:-1] = True, ~inside[1:]
        starts = np.flatnonzero(inside & (before | edge[:-1]))
        ends = np.flatnonzero(inside & (after | edge[1:]))
        sums = np.cumsum(self.table[data] * self.pow[:n])
        h = sums[ends]
        h[starts > 0] -= sums[starts[starts > 0] - 1]
        return mix(h * self.inv[starts]), starts, ends


class Places:
    """Places of hashes among ``keys`` (int64, distinct, sorted), found by their high bits.

    About one key to a range of hashes, whatever their number, so a search reads a few entries.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.append(keys, keys[-1:])  # one more, for hashes above the last range with a key
        bits = max(len(keys).bit_length(), 10)
        self.shift = np.uint64(64 - bits)
        n = np.bincount(self._range(keys), minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        self.several = n > 1

    def _range(self, h: np.ndarray) -> np.ndarray:
        return ((h.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).view(np.int64)  # in the order of signed numbers

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each of ``h`` (int64), and whether it is a key; the place of others is any."""
        if not len(self.keys):
            return np.zeros(len(h), np.int32), np.zeros(len(h), bool)
        at = self._range(h)
        place = self.first[at]
        found = self.keys[place] == h
        left = np.flatnonzero(self.several[at] & ~found)
        while len(left):
            place[left] += 1
            found[left] = self.keys[place[left]] == h[left]
            left = left[~found[left] & (place[left] + 1 < self.first[at[left] + 1])]
        return np.minimum(place, len(self.keys) - 2), found


def columns(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null reads as empty."""
    col = pc.fill_null(batch.column(batch.schema.get_field_index(name)), "").cast(pa.large_string())
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.empty(0, np.uint8)
    return data, offsets


def groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose bytes stay under ``most``; a longer row is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_pieces(
    hasher: Hasher, data: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, bytes, hashes, first bytes, last bytes, word offsets) for row ranges [i, j).

    A row of more than ``GROUP_BYTES`` comes in several pieces, cut at white space.
    """
    for i, j in groups(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        if j - i > 1 or hi - lo <= GROUP_BYTES:
            rel = offsets[i : j + 1] - lo
            h, starts, ends = hasher.words(data[lo:hi], rel)
            yield i, j, data[lo:hi], h, starts, ends, np.searchsorted(starts, rel)
            continue
        at = lo
        while at < hi:
            to = min(at + GROUP_BYTES, hi)
            while to < hi:  # up to the next white space, however far
                stop = np.flatnonzero(hasher.space[data[to : to + GROUP_BYTES]])
                if len(stop):
                    to += int(stop[0])
                    break
                to = min(to + GROUP_BYTES, hi)
            h, starts, ends = hasher.words(data[at:to], np.empty(0, np.int64))
            yield i, j, data[at:to], h, starts, ends, np.array([0, len(h)])
            at = to


def word_groups(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For row ranges [i, j): the hashes of all their words and each row's word offsets."""
    long_row, parts = -1, []
    for i, j, piece, h, _, _, at in word_pieces(hasher, data, offsets):
        if long_row >= 0 and i != long_row:
            h_all = np.concatenate(parts)
            yield long_row, long_row + 1, h_all, np.array([0, len(h_all)])
            long_row, parts = -1, []
        if j - i == 1 and int(offsets[j] - offsets[i]) > GROUP_BYTES:
            long_row = i
            parts.append(h)
        else:
            yield i, j, h, at
    if long_row >= 0:
        h_all = np.concatenate(parts)
        yield long_row, long_row + 1, h_all, np.array([0, len(h_all)])


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment (0 for an empty one)."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
