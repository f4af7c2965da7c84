"""Byte-level BPE encoding and decoding (11): batched numpy merge rounds.

Texts are cut into words as the tokenizer's byte-level pre-tokenizer does, and the new words
of a group of texts are encoded together.  Their symbols lie in one flat array.  Each round
looks up every neighbouring pair by binary search over the sorted pair keys (left id times
the vocabulary's size plus right id), takes the lowest rank of each word (``reduceat``) and
merges all its occurrences from the left; words without a known pair leave the array, so a
round touches only words that are still in work.

A word of more than ``LONG_BYTES`` bytes (a text without white space) would need about one
round per rank that occurs in it, each over the whole word.  Its pairs are kept by rank
instead, with links to the symbols before and after, and a round visits only the places of
one rank: a merge never makes a pair of a lower rank, which ``Merges`` checks when it loads.

Words repeat, so a task keeps the ids of the words it has met, up to ``CACHE_BYTES``: first
of what lies between single spaces, then, for what is new there, of the words within.
Long texts are cut into pieces before a white space that follows another character; a word
always begins there.  Nothing is shuffled: the operator is one pass over the texts.

Cases: null and empty texts have no ids and decode to the empty text; a text of any length is
whole; a special token's string in a text is that token unless ``plain_specials``; rows that
repeat a doc_id are encoded one by one; null doc_ids stay; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemark.llm.common import read_table, releasing
from tidemark.llm.merges import Merges, ragged
from tidemark.llm.packing import BYTE_BPE, tokenizer_path

#: Cached words of a task: text and ids, in bytes.
CACHE_BYTES = 48 << 20
#: Characters of texts whose words are looked up together, and of one piece of a long text.
GROUP_CHARS = 1 << 21
# The word pattern of byte-level tokenizers.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT_PATTERN = r"(?<=\S)\s"

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def unsettled_letters() -> str:
    """A character class of letters and numbers that are newer than Python's Unicode tables.

    ``regex`` and the tokenizer may know different Unicode versions.  Where Python's own
    tables, the oldest of the three, leave a character unassigned, the tokenizer's own
    pre-tokenizer decides.
    """
    import regex

    found = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)])))
    runs: list[list[int]] = []
    for cp in (ord(c) for c in found if unicodedata.category(c) == "Cn"):
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in runs)


class _Ids:
    """Keys and their ids; keys met for the first time are numbered at once and learnt later."""

    class _Index(dict):
        def __missing__(self, key) -> int:
            number = self[key] = len(self)
            self.fresh.append(key)
            return number

    def __init__(self) -> None:
        self.index = self._Index()
        self.index.fresh = []
        self.pool, self.start, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def numbers(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))

    def take(self) -> list:
        fresh, self.index.fresh = self.index.fresh, []
        return fresh

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """The ids of the keys last taken, in their order."""
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(counts) - counts])
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        self.count = np.concatenate([self.count, counts])

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        return ragged(self.pool, self.start[numbers], self.count[numbers])


class ByteBpe:
    """Encoder and decoder of whole texts by a byte-level BPE file.

    ``unsettled`` is ``unsettled_letters()``, which the driver computes once.
    """

    def __init__(self, path: str, unsettled: str, plain_specials: bool = False) -> None:
        import regex

        self.merges = Merges(path)
        self.words = regex.compile(WORD_PATTERN).findall
        self.cut = regex.compile(CUT_PATTERN)
        self.unsafe = re.compile(r"\s ")
        self.unsettled = regex.compile(f"[{unsettled}]").search if unsettled else lambda text: None
        self.specials = {} if plain_specials else self.merges.special
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.parts, self.held = _Ids(), _Ids(), 0

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces that begin where a word begins."""
        at = 0
        while len(text) - at > GROUP_CHARS:
            m = self.cut.search(text, at + GROUP_CHARS)
            if m is None:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def _cut(self, text: str) -> list:
        if text.isascii() or not self.unsettled(text):
            return self.words(text)
        from tokenizers.pre_tokenizers import ByteLevel

        own = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in own.pre_tokenize_str(text)]

    def _chunks(self, text: str) -> list:
        """Keys of the text's chunks: a string stands for a space and itself, ``(word,)`` for the
        word alone, a number for a special token.

        A word begins at each space behind another character than white space; only a text
        where white space comes before a space is cut by the pattern itself.
        """
        if self.unsafe.search(text):
            return [(w,) for w in self._cut(text)]
        first, *rest = text.split(" ")
        return [(first,), *rest] if first else rest

    def _keys(self, text: str) -> list:
        if self.split is None or not any(s in text for s in self.specials):
            return self._chunks(text)
        out = []
        for k, part in enumerate(self.split(text)):
            out += [self.specials[part]] if k % 2 else self._chunks(part)
        return out

    def _learn(self) -> None:
        """Encode the chunks met since the last time."""
        fresh = self.chunks.take()
        if not fresh:
            return
        cut = [[k] if isinstance(k, int) else self._cut(k[0] if isinstance(k, tuple) else " " + k) for k in fresh]
        numbers = self.parts.numbers(list(itertools.chain.from_iterable(cut)))
        words = self.parts.take()
        data = [b"" if isinstance(w, int) else w.encode() for w in words]
        ids, counts = self.merges.encode_words(data)
        for k in [k for k, w in enumerate(words) if isinstance(w, int)]:  # each special token once
            ids = np.insert(ids, int(counts[:k].sum()), words[k])
            counts[k] = 1
        self.parts.add(ids, counts)
        sizes = np.array([len(c) for c in cut])
        of_words = self.parts.count[numbers]
        ends = np.concatenate([[0], np.cumsum(of_words)])[np.cumsum(sizes)]
        ids = self.parts.gather(numbers)
        self.chunks.add(ids, np.diff(ends, prepend=0))
        self.held += 4 * len(ids) + sum(len(k) if isinstance(k, str) else 8 for k in fresh) + 150 * (len(fresh) + len(words))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        group: list[tuple[list, bool]] = []  # (chunks of a piece, whether the text ends with it)
        chars, kept = 0, []
        for text in texts:
            parts = list(self.pieces(text))
            for k, part in enumerate(parts):
                group.append((self._keys(part), k + 1 == len(parts)))
                chars += len(part)
                if chars >= GROUP_CHARS:
                    yield from self._flush(group, kept)
                    group, chars = [], 0
        yield from self._flush(group, kept)

    def _flush(self, group: list[tuple[list, bool]], kept: list[np.ndarray]) -> Iterator[np.ndarray]:
        if self.held > CACHE_BYTES:
            self._forget()
        at = [self.chunks.numbers(keys) for keys, _ in group]
        self._learn()
        for numbers, (_, last) in zip(at, group):
            kept.append(self.chunks.gather(numbers))
            if last:
                yield np.concatenate(kept) if len(kept) > 1 else kept[0]
                kept.clear()

    def decode(self, ids: np.ndarray) -> str:
        return self.merges.decode(ids).decode("utf-8", errors="replace")


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``: the ids (array of int) of each whole text."""
    unsettled = unsettled_letters()
    schema = docs.drop(out).schema.add(out, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, unsettled)
        for batch in batches:
            ids = list(bpe.encode([t or "" for t in batch.column(text).to_pylist()]))
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    return docs.drop(out).mapInArrow(releasing(run), schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with ``out``: the text of the ids of each row (null: empty)."""
    unsettled = unsettled_letters()
    schema = encoded.drop(out).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, unsettled)
        for batch in batches:
            texts = [bpe.decode(np.asarray(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return encoded.drop(out).mapInArrow(releasing(run), schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """DIGESTS of every document: its ids, and the text that they decode to."""
    unsettled = unsettled_letters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, unsettled)
        for batch in batches:
            sizes, of_ids, of_text = [], [], []
            for ids in bpe.encode([t or "" for t in batch.column(1).to_pylist()]):
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), DIGESTS)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))
