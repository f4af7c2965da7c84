"""Cross-tokenizer alignment (12): lockstep vectorised merging of token ends.

A document's tokens by A (byte-level BPE) and B (pieces with byte fallback) cover the same
bytes.  One NumPy state vector holds the A and B pointers of all documents of a batch: each
step compares the byte ends under the pointers, emits a link and a cut where they are equal,
advances the pointers whose token ends first (both, if equal) and compacts the finished ones
away.  A long document runs as several lanes at a time, cut at single spaces between other
characters, where both tokenizers begin a new token; one without such spaces stays one lane.

Linked tokens end together, so one's bytes are a suffix of the other's.  The pairs that can
ever be linked are therefore known from the two vocabularies alone, at most the sum of their
tokens' lengths (``Pairs.bound``, about half a million here, whatever the corpus).  Links are
stored as numbers of that list, counted per task in one vector and summed by Spark; the counts
come back as one broadcast of that bound.  Nothing else is shuffled, each text is read once.

Cases: texts null, empty, or with other bytes in either token list (a literal U+2581, say) have
no tokens: zeros, and '' for the digest; rows that repeat a doc_id are aligned one by one and
all count; null doc_ids stay; special tokens' strings are plain text; texts of any length are
whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import CACHE_BYTES, ByteBpe, _Ids, unsettled_letters
from tidemark.llm.common import cut, read_table, releasing
from tidemark.llm.merges import Merges, ragged
from tidemark.llm.packing import BYTE_BPE, tokenizer_path

PIECE_BPE = "piece_bpe_32k.model"
#: Characters of a lane, and of the documents that are aligned at a time.
LANE_CHARS = 1 << 10
GROUP_CHARS = 1 << 20

#: Where a lane may begin: both tokenizers begin a token at this space.
LANE_CUT = regex.compile(r"(?<=\S) (?=\S)")

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>"
SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def piece_bytes(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model."""
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


class Pairs:
    """All pairs of an A id and a B id of which one's bytes are a suffix of the other's.

    Up to two ids of B have the same bytes (a byte and a piece), so there are at most
    ``bound`` pairs.  The driver lists them once; tasks get the list by broadcast.
    """

    def __init__(self, a: list[bytes], b: list[bytes]) -> None:
        self.width = len(b)
        self.bound = 2 * sum(map(len, a)) + sum(map(len, b))
        of_a, of_b = self._by_bytes(a), self._by_bytes(b)
        keys = set()
        for text, ids in of_a.items():
            for k in range(len(text)):
                keys.update(i * self.width + j for j in of_b.get(text[k:], ()) for i in ids)
        for text, ids in of_b.items():
            for k in range(1, len(text)):
                keys.update(i * self.width + j for i in of_a.get(text[k:], ()) for j in ids)
        self.keys = np.sort(np.fromiter(keys, np.int64, len(keys)))
        assert len(self.keys) <= self.bound

    @staticmethod
    def _by_bytes(texts: list[bytes]) -> dict[bytes, list[int]]:
        out: dict[bytes, list[int]] = {}
        for i, t in enumerate(texts):
            out.setdefault(t, []).append(i)
        return out

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.keys, wanted)
        if len(wanted) and not (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted).all():
            raise ValueError("a link between tokens that cannot end together")
        return at.astype(np.int32)


def lockstep(end_a: np.ndarray, start_a: np.ndarray, end_b: np.ndarray, start_b: np.ndarray):
    """Links ``(index in A, index in B)`` of all lanes, in order.

    ``end_x`` holds the byte ends of the tokens of all lanes, one lane after the other, counted
    within the lane; ``start_x`` where each lane begins, and the total.  Both sides of a lane
    cover the same bytes.
    """
    lanes = np.flatnonzero(start_a[1:] > start_a[:-1])
    a, b, stop = start_a[lanes], start_b[lanes], start_a[lanes + 1]
    links_a, links_b = [], []
    while len(a):
        at_a, at_b = end_a[a], end_b[b]
        same = at_a == at_b
        links_a.append(a[same])
        links_b.append(b[same])
        a = a + (at_a <= at_b)
        b = b + (at_b <= at_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    if not links_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat_a, flat_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(flat_a, kind="stable")
    return flat_a[order], flat_b[order]


class Aligner:
    """Aligns batches of whole texts; ``unsettled`` as in ``ByteBpe``."""

    def __init__(self, path_a: str, path_b: str, unsettled: str) -> None:
        import sentencepiece

        self.a = ByteBpe(path_a, unsettled, plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_b = piece_bytes(self.b)
        self.length_a = self.a.merges.lengths
        self.length_b = np.array([len(x) for x in bytes_b])
        self.pool_b = np.frombuffer(b"".join(bytes_b), np.uint8)
        self.start_b = np.cumsum(self.length_b) - self.length_b
        names_a, names_b = ([str(i) for i in range(n)] for n in (len(self.length_a), len(self.length_b)))
        self.words, self.words_held = _Ids(), 0
        text = lambda lead, names: np.array([lead + x for x in names], object)
        self.text_a = text("", names_a), text(";", names_a), text(",", names_a)
        self.text_b = text("|", names_b), text(",", names_b)

    @staticmethod
    def lanes(text: str) -> list[str]:
        """The text in lanes, each without the space before it."""
        out, at = [], 0
        while len(text) - at > LANE_CHARS:
            m = LANE_CUT.search(text, at + LANE_CHARS)
            if m is None:
                break
            out.append(text[at : m.start()])
            at = m.end()
        return [*out, text[at:]]

    def align(self, texts: list[str]) -> list[tuple]:
        """``(ids of A, ids of B, A indexes of links, B indexes of links)`` of each text.

        Ids are empty for texts that either tokenizer does not reproduce.
        """
        per_text = [self.lanes(t) if t else [] for t in texts]
        lanes = [lane for part in per_text for lane in part]
        ids_a = list(self.a.encode([" " + lane for lane in lanes]))
        ids_b = self._pieces(lanes)
        whole, at = [], 0
        for t, part in zip(texts, per_text):
            mine = slice(at, at + len(part))
            at = mine.stop
            if part and not self._same(t, ids_a[mine], ids_b[mine]):
                ids_a[mine] = ids_b[mine] = [np.empty(0, np.int64)] * len(part)
            whole.append(mine)
        flat_a, from_a, end_a = self._flat(ids_a, self.length_a)
        flat_b, from_b, end_b = self._flat(ids_b, self.length_b)
        link_a, link_b = lockstep(end_a, from_a, end_b, from_b)
        out = []
        for mine in whole:
            a0, a1, b0, b1 = from_a[mine.start], from_a[mine.stop], from_b[mine.start], from_b[mine.stop]
            x, y = np.searchsorted(link_a, [a0, a1])
            out.append((flat_a[a0:a1], flat_b[b0:b1], link_a[x:y] - a0, link_b[x:y] - b0))
        return out

    def _pieces(self, lanes: list[str]) -> list[np.ndarray]:
        """B's ids of each lane.  No piece goes on behind a space that follows another character,
        so a lane of single spaces is put together from its words, each encoded once."""
        if self.words_held > CACHE_BYTES:
            self.words, self.words_held = _Ids(), 0
        whole = [not lane or "  " in lane or "▁" in lane or lane[0] == " " or lane[-1] == " " for lane in lanes]
        at = [np.empty(0, np.int64) if w else self.words.numbers(lane.split(" ")) for lane, w in zip(lanes, whole)]
        fresh = self.words.take()
        if fresh:
            ids = self.b.encode(fresh, num_threads=1)
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
            self.words.add(flat, np.array([len(x) for x in ids], np.int64))
            self.words_held += 4 * len(flat) + sum(map(len, fresh)) + 150 * len(fresh)
        rest = iter(self.b.encode([lane for lane, w in zip(lanes, whole) if w], num_threads=1) if any(whole) else [])
        return [np.array(next(rest), np.int64) if w else self.words.gather(n) for w, n in zip(whole, at)]

    def _same(self, text: str, a: list[np.ndarray], b: list[np.ndarray]) -> bool:
        data = (" " + text).encode()
        b = np.concatenate(b)
        return (
            ragged(self.pool_b, self.start_b[b], self.length_b[b]).tobytes() == data
            and self.a.merges.decode(np.concatenate(a)) == data
        )

    @staticmethod
    def _flat(ids: list[np.ndarray], lengths: np.ndarray):
        flat = np.concatenate([*ids, np.empty(0, np.int64)]).astype(np.int64)
        start = np.cumsum([0, *map(len, ids)])
        ends = np.cumsum(lengths[flat])
        before = np.concatenate([[0], ends])[start[:-1]]
        return flat, start, ends - np.repeat(before, np.diff(start))

    def groups(self, a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids between cuts."""
        if not len(a):
            return ""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[link_a], last_b[link_b] = 1, 1
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # groups before each token
        first_a, first_b = np.append(True, last_a[:-1] > 0), np.append(True, last_b[:-1] > 0)
        out = np.empty(len(a) + len(b), object)
        alone, opens, more = self.text_a
        named = np.where(first_a, opens[a], more[a])
        named[0] = alone[a[0]]
        out[np.arange(len(a)) + np.append(0, link_b + 1)[of_a]] = named
        opens, more = self.text_b
        out[np.arange(len(b)) + link_a[of_b] + 1] = np.where(first_b, opens[b], more[b])
        return "".join(out.tolist())


def align_documents(docs: DataFrame, path_a: str, path_b: str, pairs: Pairs) -> DataFrame:
    """ALIGNED: each text's tokens, groups and links, these as numbers of ``pairs``."""
    unsettled = unsettled_letters()
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def rows(aligner: Aligner, doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        found = aligner.align(texts)
        strings = [aligner.groups(*x) for x in found]
        numbers = [shared.value.number(a[la], b[lb]) for a, b, la, lb in found]
        ends = np.cumsum([0, *map(len, numbers)])
        columns = [
            pa.array(doc_ids, pa.int64()),
            *[pa.array([len(x[k]) for x in found], pa.int64()) for k in range(3)],
            pa.array([hashlib.sha256(s.encode()).hexdigest() if s else "" for s in strings], pa.string()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*numbers, np.empty(0, np.int32)]))),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b, unsettled)
        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= GROUP_CHARS:
                    yield rows(aligner, ids, texts)
                    ids, texts, chars = [], [], 0
        if ids:
            yield rows(aligner, ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), ALIGNED)


def vocabulary_pairs(path_a: str, path_b: str) -> Pairs:
    import sentencepiece

    return Pairs(Merges(path_a).token_bytes, piece_bytes(sentencepiece.SentencePieceProcessor(model_file=path_b)))


def pair_counts(aligned: DataFrame, n_pairs: int) -> DataFrame:
    """``(pair, n)``: how many links of the corpus hold each pair; one vector per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_pairs)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def score_links(aligned: DataFrame, pairs: Pairs) -> DataFrame:
    """SCORED: each document's links against the counts of the whole corpus."""
    counted = pair_counts(aligned, len(pairs.keys)).toPandas()  # at most len(pairs.keys) rows, from the vocabularies
    counts = np.zeros(len(pairs.keys), np.int64)
    counts[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    of_b = pairs.keys % pairs.width
    highest = np.zeros(pairs.width, np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == highest[of_b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            at = batch.column("pairs")
            numbers = at.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *(at.value_lengths().to_numpy(zero_copy_only=False))])
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")),
                    pa.array(np.diff(ends)), pa.array(sums(best[numbers])), pa.array(sums(counts[numbers])),
                    batch.column("groups_sha256"),
                ],
                [f.split()[0] for f in SCORED.split(", ")],
            )

    return aligned.mapInArrow(run, SCORED)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE)
    pairs = vocabulary_pairs(path_a, path_b)
    aligned = cut(align_documents(read_table(spark, sf_dir, "documents"), path_a, path_b, pairs), "aligned")
    return score_links(aligned, pairs)
