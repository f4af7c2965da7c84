"""LM scoring (8): a hierarchical Pitman-Yor model of word classes and their words.

A text is its words, lower-cased (A-Z), and one end.  Each word has a class: the ``TOP``
most frequent words of the training texts have one each, the others that of their last
byte (``ENDINGS``).  The end is class 0, which also stands before the first word.

    P(word | before) = P(class | up to three classes before) * P(word | class)

P(class | classes before) comes from a hierarchy of restaurants, one per context, whose
parent is the context without its oldest class.  Seatings are sampled by Gibbs: the
customers of a dish sit down again given the rest, a new table with weight
(theta + d tables) P_parent, and every table sends a customer to the parent.  Blocks of
customers of a frequent dish sit down together.  The predictive probabilities of
``SAMPLES`` seatings are averaged.  Contexts that end in the same class form one
group; groups are sampled in parallel given the root, the root from the tables that they
send, in ``ROUNDS`` rounds.

P(word | class) is one restaurant per class over an unbounded base, so each dish has one
table and nothing is left to sample, with the discount d = n1 / (n1 + 2 n2) of its words
seen once and twice:

    known: (c - d) / (theta + N)        new: (theta + d V) / (theta + N)

A word that training has not seen is the outcome "new" of its class, as it is one
outcome of the unigram base; its spelling beyond the class is not scored.  So the
probabilities of all known words, the new ones of all classes and the end sum to one.

All counts come from all training texts: each task counts its own words, then class
4-grams, and grouped sums add them up.  The model of classes has ``CLASSES``^4 probabilities
(8 MB) whatever the input, and is broadcast.  Counts of words grow with the input: the
``HEAD`` most frequent hashes are broadcast; rarer words, with no bound on their number,
are joined.

Cases: null, empty and white-space texts are the end alone; a null doc_id counts as the
text "" in the split; rows that repeat a doc_id are scored each; a very long text is
worked off in pieces that keep the classes before; without training texts each class has
probability 1 / ``CLASSES`` and every word is new; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import word_contexts
from tidemark.llm.common import cut, read_table, releasing
from tidemark.llm.seating import seat
from tidemark.llm.textbytes import Hasher, Places, columns, segment_sum, word_pieces

CLASSES, BITS = 32, 5
END, TOP = 0, 16
#: Classes of the other words by their last byte; then other ASCII, then bytes above 127.
ENDINGS = ("a", "e", "i", "o", "uy", "n", "s", "lr", "t", "d", "bcfghjkmpqvwxz", ".", ",")
OTHER = 1 + TOP + len(ENDINGS)
HIGH = OTHER + 1
#: Discount and strength of the restaurants by context length 0..3.
DISCOUNT = (0.2, 0.4, 0.6, 0.75)
STRENGTH = (1.0, 1.0, 1.0, 1.0)
#: Strength of the restaurants of words.
WORD_STRENGTH = 1.0
ROUNDS, BURN_IN, SAMPLES = 2, 5, 5
HEAD = 1 << 20
#: Words that a counting task holds before it passes them on.
HELD = 400_000


class WordClasses:
    """The class of words; ``top``: hashes of the words with a class of their own, by rank."""

    def __init__(self, top: np.ndarray) -> None:
        order = np.argsort(top)
        self.keys, self.ids = top[order], order + 1
        self.places = Places(self.keys)
        self.by_byte = np.full(256, OTHER, np.int64)
        self.by_byte[128:] = HIGH
        for k, letters in enumerate(ENDINGS):
            for c in letters + letters.upper():
                self.by_byte[ord(c)] = 1 + TOP + k

    def of(self, data: np.ndarray, h: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.by_byte[data[ends]]
        place, own = self.places.find(h)
        out[own] = self.ids[place[own]]
        return out


def events(classes: np.ndarray, at: np.ndarray, before: list[int], close: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys (three classes before, class) of the words of each row, then of its end if ``close``, and row offsets.

    ``before``: the classes before a row that goes on, latest first.
    """
    sizes = np.diff(at) + close
    off = np.concatenate([[0], np.cumsum(sizes)])
    symbol = np.full(off[-1], END, np.int64)
    symbol[np.arange(len(classes)) + close * np.repeat(np.arange(len(sizes)), np.diff(at))] = classes
    inside = np.arange(off[-1]) - np.repeat(off[:-1], sizes)
    key = symbol.copy()
    for k in (1, 2, 3):
        key[k:] |= np.where(inside[k:] >= k, symbol[:-k], END) << (BITS * k)
        for p in range(min(k, len(key)) if before else 0):
            key[p] |= before[k - p - 1] << (BITS * k)
    return key, off


def class_pieces(hasher: Hasher, classes: WordClasses, data: np.ndarray, offsets: np.ndarray):
    """(i, j, hashes, classes, word offsets, keys, key offsets) for row ranges [i, j); a long row in several pieces."""
    done, before = 0, []
    for i, j, piece, h, _, ends, at in word_pieces(hasher, data, offsets):
        h, size = h.view(np.int64), int(offsets[j] - offsets[i])
        kinds = classes.of(piece, h, ends)
        done += len(piece)
        close = done == size
        key, off = events(kinds, at, before, close)
        yield i, j, h, kinds, at, key, off
        if close:
            done, before = 0, []
        else:
            before = [*kinds[:-4:-1].tolist(), *(before or [END] * 3)][:3]


def summed(kind: np.ndarray, key: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Kind and sum of ``n`` (by default, the number) of each distinct key."""
    order = np.argsort(key)
    ranked = key[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(key)])
    if n is None:
        total = np.diff(starts, append=len(key))
    else:
        total = np.add.reduceat(n[order], starts) if len(key) else n
    return kind[order[starts]], ranked[starts], total


def word_counts(rows: DataFrame) -> DataFrame:
    """``(kind, key, n)`` of ``rows`` (text), written: words by hash with the class of their last byte, and the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, by_ending, docs = Hasher(), WordClasses(np.empty(0, np.int64)), 0
        parts, held = [], 0  # kinds, words and their numbers of groups of texts

        def found(kind: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "key", "n"])

        for batch in batches:
            data, offsets = columns(batch, "text")
            docs += batch.num_rows
            for _, _, piece, h, _, ends, _ in word_pieces(hasher, data, offsets):
                h = h.view(np.int64)
                parts.append(summed(by_ending.of(piece, h, ends), h))
                held += len(parts[-1][1])
                if held > 2 * HELD:
                    parts = [summed(*map(np.concatenate, zip(*parts)))]
                    held = len(parts[0][1])
                    if held > HELD:
                        yield found(*parts[0])
                        parts, held = [], 0
        if held:
            yield found(*summed(*map(np.concatenate, zip(*parts))))
        if docs:
            arrays = [pa.array([END], pa.int32()), pa.array([0], pa.int64()), pa.array([docs])]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "key", "n"])

    counted = rows.select("text").mapInArrow(run, "kind int, key long, n long")
    return cut(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-words")


def class_counts(rows: DataFrame, classes: WordClasses) -> DataFrame:
    """``(key, n)`` of the class 4-grams of ``rows`` (text), written; ``CLASSES``^4 rows at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, grams = Hasher(), np.zeros(CLASSES**4, np.int64)
        for batch in batches:
            data, offsets = columns(batch, "text")
            for *_, key, _ in class_pieces(hasher, classes, data, offsets):
                some, n = np.unique(key, return_counts=True)
                grams[some] += n
        some = np.flatnonzero(grams)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(grams[some])], ["key", "n"])

    counted = rows.select("text").mapInArrow(run, "key long, n long")
    return cut(counted.groupBy("key").agg(F.sum("n").alias("n")), "lm-grams")


def predictive(n: np.ndarray, t: np.ndarray, parent: np.ndarray, level: int) -> np.ndarray:
    """P(dish) in each restaurant (last axis: dishes) given its customers, tables and parent."""
    d, theta = DISCOUNT[level], STRENGTH[level]
    back = theta + d * t.sum(-1, keepdims=True)
    return (np.maximum(n - d * t, 0) + back * parent) / (theta + n.sum(-1, keepdims=True))


def sample_group(n3: np.ndarray, root: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Averaged P(w | a, b, c) of one group c and its mean tables at the root's children.

    ``n3[a, b, w]``: customers of the contexts of three symbols that end in c.
    """
    rng = np.random.default_rng(seed)
    t3, t2, t1 = np.minimum(n3, 1.0), None, None
    mean, sent = np.zeros(n3.shape), np.zeros(CLASSES)
    n2 = t3.sum(0)
    t2 = np.minimum(n2, 1.0)
    n1 = t2.sum(0)
    t1 = np.minimum(n1, 1.0)
    for sweep in range(BURN_IN + SAMPLES):
        p1 = predictive(n1, t1, root, 1)
        p2 = predictive(n2, t2, p1, 2)
        weight = (STRENGTH[3] + DISCOUNT[3] * t3.sum(-1, keepdims=True)) * p2
        t3 = seat(n3, weight, DISCOUNT[3], rng)
        n2 = t3.sum(0)
        weight = (STRENGTH[2] + DISCOUNT[2] * t2.sum(-1, keepdims=True)) * p1
        t2 = seat(n2, weight, DISCOUNT[2], rng)
        n1 = t2.sum(0)
        t1 = seat(n1, (STRENGTH[1] + DISCOUNT[1] * t1.sum()) * root, DISCOUNT[1], rng)
        if sweep >= BURN_IN:
            p1 = predictive(n1, t1, root, 1)
            p2 = predictive(n2, t2, p1, 2)
            mean += predictive(n3, t3, p2, 3)
            sent += t1
    return mean / SAMPLES, sent / SAMPLES


def group_sampler(root: np.ndarray, turn: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        key = part["key"].to_numpy()
        n = np.zeros((CLASSES, CLASSES, CLASSES))
        n[key >> (3 * BITS), (key >> (2 * BITS)) & (CLASSES - 1), key & (CLASSES - 1)] = part["n"].to_numpy()
        c = int(part["c"].iloc[0])
        mean, sent = sample_group(n, root, 1000 * turn + c)
        return pd.DataFrame({"c": [c], "p": [mean.astype("<f4").tobytes()], "sent": [sent.tolist()]})

    return run


def sample_model(counts: DataFrame) -> np.ndarray:
    """P(class | three before) as an array by 4-gram key, from the grouped counts."""
    grams = counts.select("key", "n", F.expr(f"shiftright(key, {BITS}) & {CLASSES - 1}").alias("c"))
    # the root's customers at first: one per last class and dish
    first = grams.select("c", F.expr(f"key & {CLASSES - 1}").alias("w")).distinct().groupBy("w").count().collect()
    customers = np.zeros(CLASSES)
    for r in first:
        customers[r["w"]] = r["count"]
    uniform, rng, blocks = np.full(CLASSES, 1 / CLASSES), np.random.default_rng(1), []
    for turn in range(ROUNDS):
        tables = np.minimum(customers, 1.0)
        for _ in range(BURN_IN):
            weight = (STRENGTH[0] + DISCOUNT[0] * tables.sum()) * uniform
            tables = seat(np.round(customers), weight, DISCOUNT[0], rng)
        root = predictive(customers, tables, uniform, 0)

        blocks = grams.groupBy("c").applyInPandas(group_sampler(root, turn), "c int, p binary, sent array<double>").collect()  # CLASSES rows
        customers = sum((np.array(r["sent"]) for r in blocks), np.zeros(CLASSES))
    model = np.empty((CLASSES, CLASSES, CLASSES, CLASSES), np.float32)  # a, b, c, w
    model[:] = root
    for r in blocks:
        model[:, :, r["c"], :] = np.frombuffer(r["p"], "<f4").reshape(CLASSES, CLASSES, CLASSES)
    return model.reshape(-1)


def head_words(counts: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (sorted), counts and classes by last byte of the most frequent words, ``most`` at most."""
    words = counts.filter(F.col("kind") != END)
    level = F.floor(F.log2("n") * 8).cast("int")
    by_level = {r["level"]: r["count"] for r in words.groupBy(level.alias("level")).count().collect()}  # 8 * 63 rows at most
    total, least = 0, None
    for k in sorted(by_level, reverse=True):
        total += by_level[k]
        if total > most:
            break
        least = k
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    rows = words.filter(level >= least).select("key", "n", "kind").toArrow()  # 20 bytes a row, no row objects
    keys, n, kind = (rows[c].to_numpy() for c in ("key", "n", "kind"))
    order = np.argsort(keys)
    return keys[order], n[order], kind[order]


class Model(NamedTuple):
    """What scoring needs besides the counts of words."""

    classes: WordClasses
    #: log10 P(class | three before) by 4-gram key
    grams: np.ndarray
    #: per class: discount, log10 of theta + N, log10 of P(new)
    discount: np.ndarray
    room: np.ndarray
    new: np.ndarray


def fit(rows: DataFrame, counts: DataFrame) -> Model:
    """The model of the training ``rows`` (text) and their ``word_counts``."""
    words = counts.filter(F.col("kind") != END)
    top = np.array([r["key"] for r in words.orderBy(F.desc("n"), "key").limit(TOP).collect()], np.int64)
    classes = WordClasses(top)
    grams = np.log10(sample_model(class_counts(rows, classes)).astype(np.float64))
    # END and the top words are the only dish of their class: probability 1, nothing new
    discount, room, new = np.zeros(CLASSES), np.zeros(CLASSES), np.zeros(CLASSES)
    once = lambda k: F.sum(F.when(F.col("n") == k, 1).otherwise(0))
    others = words.filter(~F.col("key").isin(top.tolist())) if len(top) else words
    stats = others.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v"), once(1).alias("n1"), once(2).alias("n2"))
    for r in stats.collect():  # one row per class
        k, d = r["kind"], min(r["n1"] / max(r["n1"] + 2 * r["n2"], 1), 0.95)
        discount[k], room[k] = d, math.log10(WORD_STRENGTH + r["n"])
        new[k] = math.log10(WORD_STRENGTH + d * r["v"]) - room[k]
    return Model(classes, grams, discount, room, new)


RARE = "array<struct<key:long,n:long,kind:int>>"
SCORED = f"row long, part int, own long, doc_id long, held_out boolean, n_words long, known long, base double, score double, rare {RARE}"


def score_texts(rows: DataFrame, model: Model, head: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """SCORED of the words of each of ``rows`` (own, doc_id, held_out, text), written.

    ``score`` holds the classes of all words and of the end, and the known words of the
    head; ``rare`` the words beyond the head.  A very long text gives several rows of one
    ``row``, numbered by ``part``.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, *head[:2]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hasher, first_row = Hasher(), TaskContext.get().partitionId() << 36
        model, head_keys, head_counts = shared.value
        head = Places(head_keys)
        for batch in batches:
            data, offsets = columns(batch, "text")
            part_of = np.zeros(batch.num_rows, np.int32)
            for i, j, h, kinds, at, letters, off in class_pieces(hasher, model.classes, data, offsets):
                place, known = head.find(h)
                count = np.zeros(len(h), np.int64)
                count[known] = head_counts[place[known]]
                own = kinds <= TOP  # the only dish of its class
                score = np.where(own, 0.0, np.log10(np.where(known, count - model.discount[kinds], 1.0)) - model.room[kinds])
                score[~known] = 0.0
                # the distinct words beyond the head of each row, ascending
                miss = np.flatnonzero(~known)
                of_row = np.searchsorted(at, miss, "right") - 1
                order = np.lexsort((h[miss], of_row))
                miss, of_row = miss[order], of_row[order]
                new = np.concatenate([[True], (h[miss][1:] != h[miss][:-1]) | (of_row[1:] != of_row[:-1])])[: len(miss)]
                starts = np.flatnonzero(new)
                rare_at = np.searchsorted(of_row[starts], np.arange(j - i + 1))
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array(h[miss[starts]]),
                        pa.array(np.diff(starts, append=len(miss))),
                        pa.array(kinds[miss[starts]].astype(np.int32)),
                    ],
                    ["key", "n", "kind"],
                )
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(first_row + i, first_row + j)),
                        pa.array(part_of[i:j].copy()),
                        part.column(0),
                        part.column(1),
                        part.column(2),
                        pa.array(np.diff(at)),
                        pa.array(segment_sum(known.astype(np.int64), at)),
                        pa.array(segment_sum(np.log10(count + 1.0), at)),
                        pa.array(segment_sum(score, at) + segment_sum(model.grams[letters], off)),
                        pa.ListArray.from_arrays(pa.array(rare_at, pa.int32()), struct),
                    ],
                    ["row", "part", "own", "doc_id", "held_out", "n_words", "known", "base", "score", "rare"],
                )
                part_of[i:j] += 1
            first_row += batch.num_rows

    return cut(rows.select("own", "doc_id", "held_out", "text").mapInArrow(run, SCORED), "lm-scores")


def dishes(model: Model, head: tuple[np.ndarray, np.ndarray, np.ndarray]) -> word_contexts.Dishes:
    """What restaurants of word contexts serve, and its log10 probability in its class.

    The first ``CLASSES`` dishes stand for classes: the end and the top words themselves, of
    the others all words beyond the head, new ones included; then come the words of the head.
    """
    keys, n, kinds = head
    word, kind = np.zeros(CLASSES + len(keys)), np.concatenate([np.arange(CLASSES), kinds]).astype(np.int64)
    p = np.maximum(n - model.discount[kinds], 1e-300) / 10 ** model.room[kinds]
    p[np.isin(keys, model.classes.keys)] = 0.0  # they have a class of their own
    tail = 1 - np.bincount(kinds, p, CLASSES)
    word[TOP + 1 : CLASSES] = np.log10(np.maximum(tail[TOP + 1 :], 1e-300))
    by_count = np.argsort(-n, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[by_count] = np.arange(len(keys))
    word[CLASSES:] = np.log10(np.where(p > 0, p, 1.0))[by_count]
    kind[CLASSES:] = kinds[by_count]
    return word_contexts.Dishes(keys, rank, kind, word)


def context_events(rows: DataFrame, model: Model, served: word_contexts.Dishes, parts: int) -> DataFrame:
    """``word_contexts.PACKED`` events of ``rows`` (own, held_out, text), for ``parts`` parts of the contexts."""
    shared = rows.sparkSession.sparkContext.broadcast((model.classes, served.keys, served.rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hasher, (classes, head_keys, ranks) = Hasher(), shared.value
        head = Places(head_keys)
        chunk = word_contexts.Chunk(TaskContext.get().partitionId() << 36, parts)
        for batch in batches:
            data, offsets = columns(batch, "text")
            own, held = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            piece, before = 0, (0, 0)  # of a row that comes in several pieces
            for i, j, h, kinds, at, key, off in class_pieces(hasher, classes, data, offsets):
                close = off[-1] > len(h)
                found, in_head = head.find(h)
                rank = ranks[found] if len(ranks) else np.zeros(len(h), np.int64)
                code = word_contexts.codes(h, in_head, rank)
                word, dish = np.zeros((2, off[-1]), np.int64)  # the end is 0 in both
                place = np.arange(len(h)) + close * np.repeat(np.arange(j - i), np.diff(at))
                word[place], dish[place] = code, np.where(in_head & (kinds > TOP), CLASSES + rank, kinds)
                yield from chunk.add(own[i:j], held[i:j], piece, word, dish, key >> BITS, off, before)
                piece, before = (0, (0, 0)) if close else (piece + 1, (*code[:-3:-1].tolist(), *before)[:2])
        yield from chunk.flush()

    return rows.select("own", "held_out", "text").mapInArrow(releasing(run), word_contexts.PACKED)


def class_scores(docs: DataFrame, folds: int = 7, out_fold: int = 2) -> tuple[DataFrame, DataFrame, Model, tuple, int]:
    """Per row own (a hash of doc_id and text), doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    by the model of classes; the rows (own, doc_id, held_out, text), the model, the head and the training tokens."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    own = F.xxhash64("doc_id", "text").alias("own")
    rows = docs.select(own, F.col("doc_id").cast("long").alias("doc_id"), (fold == out_fold).alias("held_out"), "text")
    counts = word_counts(rows.filter("NOT held_out"))
    ends = F.col("kind") == END
    totals = {r["end"]: r for r in counts.groupBy(ends.alias("end")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    of = lambda end, what: int(totals[end][what]) if end in totals else 0
    train_docs = of(True, "n")
    tokens, distinct = of(False, "n") + train_docs, of(False, "v") + int(train_docs > 0)
    model = fit(rows.filter("NOT held_out"), counts)
    head = head_words(counts)
    scored = score_texts(rows, model, head)

    rare = scored.select("row", "part", F.explode("rare").alias("r")).select(
        "row", "part", F.col("r.key").alias("k"), F.col("r.n").alias("times"), F.col("r.kind").alias("rare_kind")
    )
    table = counts.filter(~ends).select("key", F.col("n").alias("c"))
    by_class = lambda values: F.array(*map(F.lit, values.tolist()))[F.col("rare_kind")]
    seen = F.when(F.col("rare_kind") <= TOP, 0.0).otherwise(F.log10(F.col("c") - by_class(model.discount)) - by_class(model.room))
    found = (
        rare.join(table, F.col("k") == F.col("key"), "left")
        .groupBy(F.col("row").alias("r_row"), F.col("part").alias("r_part"))
        .agg(
            F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_base"),
            F.sum(F.col("times") * F.when(F.col("c").isNotNull(), seen).otherwise(by_class(model.new))).alias("rare_score"),
        )
    )
    none = F.lit(0)
    whole = scored.join(found, (F.col("row") == F.col("r_row")) & (F.col("part") == F.col("r_part")), "left").select(
        "row",
        "part",
        "own",
        "doc_id",
        "held_out",
        "n_words",
        (F.col("known") + F.coalesce("rare_known", none)).alias("known"),
        (F.col("base") + F.coalesce("rare_base", none)).alias("base"),
        (F.col("score") + F.coalesce("rare_score", none)).alias("score"),
    )
    # the few texts in several parts are added up; the others pass without a shuffle
    long_rows = cut(scored.filter("part > 0").select(F.col("row").alias("l_row")).distinct(), "lm-long")
    if not long_rows.isEmpty():
        split = whole.join(long_rows, F.col("row") == F.col("l_row"), "left_semi")
        sums = [F.sum(c).alias(c) for c in ("n_words", "known", "base", "score")]
        added = split.groupBy("row").agg(*[F.first(c).alias(c) for c in ("own", "doc_id", "held_out")], *sums)
        whole = whole.join(long_rows, F.col("row") == F.col("l_row"), "left_anti").drop("part").unionByName(added)
    end_known = int(train_docs > 0)
    result = whole.select(
        "own",
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known") + end_known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (
            F.col("base") + math.log10(train_docs + 1.0) - (F.col("n_words") + 1) * math.log10(tokens + distinct + 1.0)
        ).alias("base_score"),
        "score",
    )
    return result, rows, model, head, tokens


def score(docs: DataFrame, folds: int = 7, out_fold: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score by the model of classes alone."""
    return class_scores(docs, folds, out_fold)[0].drop("own")


def score_in_context(docs: DataFrame, folds: int = 7, out_fold: int = 2, events: int = word_contexts.EVENTS) -> DataFrame:
    """As ``score``, by the whole model: what the restaurants of word contexts add to the classes' score.

    ``events``: about how many events one task seats.  The classes' score comes along as ``class_score``.
    """
    found, rows, model, head, tokens = class_scores(docs, folds, out_fold)
    found = found.withColumn("class_score", F.col("score"))
    if not tokens:  # no context has customers
        return found.drop("own")
    served = dishes(model, head)
    parts = math.ceil(tokens * folds / max(folds - 1, 1) / events)
    gained = word_contexts.gains(context_events(rows, model, served, parts), served, model.grams, BITS)
    gained = gained.select(F.col("own").alias("__own"), "gain")
    found = found.join(cut(gained, "lm-gains"), F.col("own") == F.col("__own"), "left")
    return found.withColumn("score", F.col("score") + F.coalesce("gain", F.lit(0.0))).drop("own", "__own", "gain")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_in_context(read_table(spark, sf_dir, "documents"))
