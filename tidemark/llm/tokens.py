"""Token ids of whole texts by a ``tokenizers`` file, through a cache of words.

Words repeat, so a task encodes each distinct one once.  A text is cut only where
the tokenizer itself always cuts: at a single space after a character that is not
white space (the space belongs to what follows).  Texts of plain characters are cut
by the tokenizer's own pattern instead, so words share their parts whatever stands
around them.  Ids are exactly those of encoding the text at once; ``tests/llm`` holds
that on random texts.
"""

from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Iterator

from tidemark.llm.merges import Merges

#: Words of one generation of a task's cache; two generations are kept.
CACHE_WORDS = 400_000
#: The same for the encoder that a worker keeps between tasks.
SHARED_WORDS = 300_000
#: Characters of a text that are cut into words at a time.
PIECE_CHARS = 1 << 21

#: The words that a lower-casing tokenizer keeps of a lower-case text of ``PLAIN``
#: characters: ASCII and the letters of Latin-1 with marks, which no normal form changes.
LOWER_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\s]+"
PLAIN = r"[!-~À-ÖØ-öø-ÿ]*"
#: Texts of such words and white space.
PLAIN_TEXT = r"[\t\n\r -~À-ÖØ-öø-ÿ]*"
#: Fixed value: the parts of a plain text for a tokenizer that keeps cases and white space (GPT-2's pattern).
SPACED_PARTS = (
    r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+"
)

#: White space of Unicode.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]


class _Words:
    """word -> its ids as little-endian unsigned 32-bit bytes; ``lead`` goes before each word.

    New words are encoded many at a time, joined by one of the tokenizer's special
    tokens: it always cuts there, and its id marks where the next word's ids begin.
    """

    def __init__(self, tokenizer, lead: str, most: int) -> None:
        self.tokenizer, self.lead, self.most = tokenizer, lead, most
        self.encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)  # ids without offsets
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        special = tokenizer.get_added_tokens_decoder()
        self.contents = [t.content for t in special.values()]
        self.mark_id, self.mark = next(((i, t.content) for i, t in special.items()), (-1, ""))

    def add(self, words: set[str]) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        new = words - self.young.keys()
        known = new & self.old.keys()
        self.young.update(zip(known, map(self.old.__getitem__, known)))
        self.learn(list(new - known))

    def learn(self, new: list[str]) -> None:
        import numpy as np

        young = self.young
        if not self.mark or any(c in text for text in [" ".join(new)] for c in self.contents):
            alone = [w for w in new if not self.mark or any(c in w for c in self.contents)]
            for w in alone:
                ids = self.tokenizer.encode(self.lead + w, add_special_tokens=False).ids
                young[w] = np.asarray(ids, dtype="<u4").tobytes()
            new = [w for w in new if w not in young]
        parts = [new[at : at + 64] for at in range(0, len(new), 64)]
        for at in range(0, len(parts), 256):
            texts = [self.mark.join([self.lead + w for w in part]) for part in parts[at : at + 256]]
            for part, e in zip(parts[at : at + 256], self.encode(texts, add_special_tokens=False)):
                ids = np.asarray(e.ids, dtype="<u4")
                data, start = ids.tobytes(), 0
                for w, end in zip(part, [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)], strict=True):
                    young[w] = data[4 * start : 4 * end]
                    start = end + 1


class _Merged(_Words):
    """Parts of words -> ids as in ``_Words``; new ones are merged together in one flat array."""

    def __init__(self, path: str, most: int) -> None:
        self.merges, self.most = Merges(path), most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        ids, counts = self.merges.encode_words([w.encode() for w in new])
        data, at = ids.astype("<u4").tobytes(), 0
        for w, n in zip(new, (4 * counts).tolist()):
            self.young[w] = data[at : at + n]
            at += n


class _Parted(_Words):
    """Words of a tokenizer that lower-cases: put together from the ids of their parts.

    Only words of ``PLAIN`` characters are cut, where the tokenizer's own pattern cuts them too;
    the tokenizer itself encodes the others.
    """

    def __init__(self, tokenizer, path: str, pattern: str, most: int) -> None:
        super().__init__(tokenizer, "", most)
        self.parts = _Merged(path, most)
        self.cut, self.plain = re.compile(pattern).findall, re.compile(PLAIN).fullmatch

    def learn(self, new: list[str]) -> None:
        plain, other = [], []
        for w in new:
            (plain if self.plain(w) and "<|" not in w else other).append(w)
        super().learn(other)
        cut = [self.cut(w.lower()) for w in plain]
        self.parts.add(set(itertools.chain.from_iterable(cut)))
        ids = self.parts.young
        self.young.update((w, ids[c[0]] if len(c) == 1 else b"".join([ids[p] for p in c])) for w, c in zip(plain, cut))


class Encoder:
    """``ids(text)`` as bytes.  ``lead`` is " " where the tokenizer keeps spaces, else "".

    ``parts`` names the words that a tokenizer keeps of lower-case plain text, for one that
    lower-cases and drops white space: texts are then lower-cased first (A-Z; the tokenizer
    does the rest), so fewer distinct words are met, and these share their parts.  ``spaced``
    names the parts of plain text for a byte-level tokenizer that keeps cases and white space.
    """

    def __init__(self, path: str, lead: str, cache_words: int = CACHE_WORDS, parts: str = "", spaced: str = "") -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.lower = bool(parts)
        if parts:
            self.first = self.rest = _Parted(tokenizer, path, parts, cache_words)
        else:
            self.first, self.rest = _Words(tokenizer, "", cache_words), _Words(tokenizer, lead, cache_words)
        self.cut, self.plain = re.compile(parts or spaced).findall, re.compile(PLAIN_TEXT).fullmatch
        self.parts = self.first.parts if parts else _Merged(path, cache_words) if spaced else None
        self.unsafe = [c + " " for c in _SPACES] if lead else []
        self.safe_space = re.compile(r"(?<=\S) (?=\S)")

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """Words of the text, in lists; only the first word of the first list starts the text."""
        if any(u in text for u in self.unsafe):
            at = 0
            words = []
            for m in self.safe_space.finditer(text):
                words.append(text[at : m.start()])
                at = m.end()
                if len(words) >= PIECE_CHARS // 8:
                    yield words
                    words = []
            yield [*words, text[at:]]
            return
        at = 0
        while True:
            to = text.find(" ", at + PIECE_CHARS) if at + PIECE_CHARS < len(text) else -1
            yield text[at : to if to >= 0 else None].split(" ")
            if to < 0:
                return
            at = to + 1

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text.  Texts are taken in groups of about ``PIECE_CHARS`` characters."""
        group, chars = [], 0
        for text in texts:
            if self.lower and "<|" not in text:  # special tokens are known by their case
                text = text.encode().lower().decode()  # A-Z only
            group.append(text)
            chars += len(text)
            if chars >= PIECE_CHARS:
                yield from self._group(group)
                group, chars = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        if len(texts) == 1:
            yield self._one(self._pieces(texts[0]))
            return
        by_parts = [k for k, t in enumerate(texts) if self._by_parts(t)] if self.parts else []
        if by_parts:
            parts = [self.cut(texts[k].lower() if self.lower else texts[k]) for k in by_parts]
            self.parts.add(set().union(*parts))
            known = self.parts.young.__getitem__
            done = {k: b"".join(map(known, p)) for k, p in zip(by_parts, parts)}
            others = self._by_words([t for k, t in enumerate(texts) if k not in done])
            yield from (done[k] if k in done else next(others) for k in range(len(texts)))
            return
        yield from self._by_words(texts)

    def _by_parts(self, text: str) -> bool:
        return len(text) <= PIECE_CHARS and "<|" not in text and self.plain(text) is not None

    def _by_words(self, texts: list[str]) -> Iterator[bytes]:
        if not texts:
            return
        cut = [list(self._pieces(t)) for t in texts]
        words = set().union(*itertools.chain.from_iterable(cut))
        first = {p[0][0] for p in cut}
        if self.first is self.rest:
            words |= first
        else:
            self.first.add(first)
        self.rest.add(words)
        for p in cut:
            rest = itertools.chain(p[0][1:], *p[1:])
            yield b"".join([self.first.young[p[0][0]], *map(self.rest.young.__getitem__, rest)])

    def _one(self, pieces: Iterator[list[str]]) -> bytes:
        out = []
        for k, words in enumerate(pieces):
            if k == 0:
                self.first.add({words[0]})
                out.append(self.first.young[words[0]])
                words = words[1:]
            self.rest.add(set(words))
            out.append(b"".join(map(self.rest.young.__getitem__, words)))
        return b"".join(out)


def shared_encoder(path: str, lead: str, parts: str = "") -> Encoder:
    """One encoder per Python worker: Spark runs many tasks in one, and their words repeat.

    The library's code ships with each task, so its own modules are new in each; the encoder
    is held by ``sys``, which is the worker's.
    """
    held = sys.__dict__.setdefault("_tidemark_encoder", {})
    key = path, lead, parts
    if key not in held:
        held.clear()
        held[key] = Encoder(path, lead, SHARED_WORDS, parts)
    return held[key]
