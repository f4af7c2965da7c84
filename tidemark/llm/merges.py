"""Merge rounds of a BPE file over flat symbol arrays: the core of ``bpe``."""

from __future__ import annotations

import heapq
import json

import numpy as np

#: Bytes of words that are merged in one flat array.
FLAT_BYTES = 1 << 18
#: Words above this go by rank.
LONG_BYTES = 1 << 11


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the others from U+0100 on in ascending order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Sorted pair keys, ranks and products of a byte-level BPE file, and the bytes of each id.

    Where the file marks the ends of words, a word's last symbol is the one with that mark.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        self.size = max([*vocab.values(), *special.values()]) + 1
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.left, self.right, self.made = left, right, made
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        # the rank that makes an id; parts of a pair are made before the pair
        born = np.full(self.size, -1, np.int64)
        born[made[::-1]] = np.arange(len(made) - 1, -1, -1)
        self.ordered = bool((np.maximum(born[left], born[right]) < np.arange(len(left))).all())
        self.first = np.zeros(256, np.int32)
        self.last = np.zeros(256, np.int32)
        end = spec["model"].get("end_of_word_suffix") or ""
        for letter, b in letters.items():
            self.first[b], self.last[b] = vocab[letter], vocab[letter + end]
        self.special = dict(sorted(special.items(), key=lambda x: -len(x[0])))
        texts = [b""] * self.size
        for token, i in [*vocab.items(), *special.items()]:
            known = all(c in letters for c in token)
            texts[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.token_bytes = texts
        self.ends = np.cumsum([len(t) for t in texts])
        self.pool = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.diff(self.ends, prepend=0)

    #: Above every rank.
    NONE = np.int32(2**31 - 1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where it is no merge."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.order[at], self.NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all words, number of ids of each word)``."""
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (word numbers, ids), words of one part together
        at = 0
        while at < len(words):
            to, size, part = at, 0, []
            while to < len(words) and size < FLAT_BYTES:
                if self.ordered and len(words[to]) > LONG_BYTES:
                    ids = self._by_rank(words[to])
                    done.append((np.full(len(ids), to), ids))
                elif words[to]:
                    part.append(to)
                    size += len(words[to])
                to += 1
            if part:
                done += self._rounds([words[k] for k in part], np.array(part))
            at = to
        if not done:
            return np.empty(0, np.int32), counts
        of = np.concatenate([w for w, _ in done])
        ids = np.concatenate([i for _, i in done])
        np.add.at(counts, of, 1)
        return ids[np.argsort(of, kind="stable")].astype(np.int32), counts

    def _rounds(self, words: list[bytes], numbers: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        data, lengths = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        symbols = self.first[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        of = np.repeat(numbers, lengths)
        done = []
        while len(symbols):
            new = np.flatnonzero(of[1:] != of[:-1]) + 1
            starts = np.concatenate([[0], new])
            rank = np.full(len(symbols), self.NONE, np.int32)
            rank[:-1] = self.ranks(symbols[:-1], symbols[1:])
            rank[new - 1] = self.NONE
            sizes = np.diff(starts, append=len(symbols))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            ready = lowest == self.NONE
            if ready.any():
                done.append((of[ready], symbols[ready]))
            hit = np.flatnonzero((rank == lowest) & ~ready)
            # a run of one pair (aaaa) merges its first, third, fifth place
            begins = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            odd = np.arange(len(hit)) - np.repeat(begins, np.diff(begins, append=len(hit)))
            hit = hit[odd % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            stay = ~ready
            stay[hit + 1] = False
            symbols, of = symbols[stay], of[stay]
        return done

    def _by_rank(self, word: bytes) -> np.ndarray:
        """Ids of one long word: rounds over the places of one rank, lowest first."""
        sym = np.append(self.first[np.frombuffer(word, np.uint8)], np.int32(-1))
        sym[-2] = self.last[word[-1]]
        n = len(word)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        alive = np.ones(n + 1, bool)
        places: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            at = at[(at >= 0) & (after[at] < n)]
            rank = self.ranks(sym[at], sym[after[at]])
            by = np.argsort(rank, kind="stable")
            rank, at = rank[by], at[by]
            cuts = np.flatnonzero(np.diff(rank, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rank)]):
                r = int(rank[a])
                if r == self.NONE:
                    break
                if r not in places:
                    places[r] = []
                    heapq.heappush(heap, r)
                places[r].append(at[a:b])

        note(np.arange(n - 1))
        while heap:
            r = heapq.heappop(heap)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[alive[at] & (sym[at] == self.left[r]) & (sym[after[at]] == self.right[r])]
            if self.left[r] == self.right[r] and len(at):
                begins = np.flatnonzero(np.append(True, after[at[:-1]] != at[1:]))
                odd = np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))
                at = at[odd % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            sym[at] = self.made[r]
            alive[gone] = False
            after[at] = after[gone]
            before[after[gone]] = at
            note(np.unique(np.concatenate([before[at], at])))
        return sym[:n][alive[:n]]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``, gathered from one pool."""
        return ragged(self.pool, self.ends[ids] - self.lengths[ids], self.lengths[ids]).tobytes()


def ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``pool[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
