"""Restaurants of word contexts: a distribution in each context, scores by brute force, pieces of long rows."""

import math
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import pitman_yor, textbytes, word_contexts
from tidemark.llm.textbytes import Hasher

HELD_OUT = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
TRAIN = next(i for i in range(200) if i not in HELD_OUT)
WORDS = [f"{a}{b}{e}" for a in "bcdfgh" for b in "aeiou" for e in ("na", "ne", "so", "ri")]


def test_each_context_has_a_distribution():
    r = np.random.default_rng(3)
    base = r.dirichlet(np.ones(20), 4)
    group, child, dish = (r.integers(0, k, 4000) for k in (3, 5, 8))  # one parent, some dishes are never seen
    asked = np.array([(g, c, w) for g in range(4) for c in range(6) for w in range(20)])
    group, child, dish = (np.concatenate(x) for x in zip((group, child, dish), asked.T))
    held = np.arange(len(group)) >= 4000
    args = group.astype(np.uint64), child.astype(np.uint64), dish, held, base[group, dish]
    gain = word_contexts.seated_gains(*args, 1)
    p = (base[group, dish] * 10**gain)[held].reshape(24, 20)
    assert np.allclose(p.sum(1), 1) and np.allclose(gain[held].reshape(4, -1)[3], 0)
    assert not np.allclose(p[0], p[1], rtol=0.01) and not np.allclose(p[5], base[0], rtol=0.01)
    assert (gain == word_contexts.seated_gains(*args, 1)).all()


@pytest.mark.parametrize("head, events", [(pitman_yor.HEAD, word_contexts.EVENTS), (pitman_yor.HEAD, 9), (3, 20)])
def test_scores_equal_brute_force(spark, monkeypatch, head, events):
    """Every word comes once in training, so every restaurant has one customer and nothing is left to sample."""
    monkeypatch.setattr(pitman_yor.head_words, "__defaults__", (head,))
    r = random.Random(7)
    train = r.sample(WORDS, 90)
    texts = [train, train, train[40:60] + train[:25], r.sample(WORDS, 50), train[30:33] * 9, [], ["new", *train[1:9]], train[::-1]]
    rows = [(TRAIN, " ".join(train))] + [(i, " ".join(t)) for i, t in zip(HELD_OUT, texts)]
    rows += [rows[3], (HELD_OUT[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fitted = docs.filter(f"doc_id = {TRAIN}")
    counts = pitman_yor.word_counts(fitted)
    model = pitman_yor.fit(fitted, counts)
    served = pitman_yor.dishes(model, pitman_yor.head_words(counts))
    hashes = Hasher()

    def kind_and_dish(word):
        data = np.frombuffer(word.encode(), np.uint8)
        h, _, ends = hashes.words(data, np.array([0, len(data)]))
        h = h.view(np.int64)
        kind = int(model.classes.of(data, h, ends)[0])
        at = np.flatnonzero(served.keys == h[0])
        return kind, (32 + int(served.rank[at[0]]) if len(at) and kind > pitman_yor.TOP else kind)

    def events_of(words):
        known = [(None, 0, 0)] * 3 + [(w, *kind_and_dish(w)) for w in words] + [(None, 0, 0)]
        for k in range(3, len(known)):
            (_, c3, _), (u, c2, _), (v, c1, _), (_, c, dish) = known[k - 3 : k + 1]
            yield (c3, c2, v), (c3, u, v), dish, (c3 << 15) | (c2 << 10) | (c1 << 5) | c

    parents, contexts = {}, {}
    for parent, context, dish, _ in events_of(train):
        assert parent not in parents and context not in contexts
        parents[parent] = contexts[context] = dish
    d = word_contexts.MOST_DISCOUNT
    got = {}
    for x in pitman_yor.score_in_context(docs, events=events).collect():
        got.setdefault((x["doc_id"], x["n_tokens"]), []).append(x)
    plain = {(x["doc_id"], x["n_tokens"]): x["score"] for x in pitman_yor.score(docs).collect()}
    assert sum(map(len, got.values())) == len(rows)
    for i, text in rows:
        words, gain = (text or "").split(), 0.0
        for parent, context, dish, key in events_of(words):
            base = p = 10 ** (model.grams[key] + served.word[dish])
            if parent in parents:
                p = ((1 - d) * (parents[parent] == dish) + (1 + d) * p) / 2
            if context in contexts:
                p = ((1 - d) * (contexts[context] == dish) + (1 + d) * p) / 2
            gain += math.log10(p / base)
        for x in got[i, len(words) + 1]:
            assert math.isclose(x["class_score"], plain[i, len(words) + 1], rel_tol=1e-9)
            assert math.isclose(x["score"] - x["class_score"], gain, rel_tol=1e-6, abs_tol=1e-6)
    copy, other = (got[HELD_OUT[k], n + 1][0] for k, n in ((0, 90), (7, 90)))
    assert copy["score"] > copy["class_score"] + 1 > other["score"]


def test_dishes_of_a_class_sum_to_one(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(WORDS, [1 / (k + 1) for k in range(len(WORDS))], k=80))) for i in range(30)]
    counts = pitman_yor.word_counts(spark.createDataFrame(rows, "doc_id long, text string"))
    model = pitman_yor.fit(spark.createDataFrame(rows, "doc_id long, text string"), counts)
    for most in (1 << 20, 40):
        served = pitman_yor.dishes(model, pitman_yor.head_words(counts, most))
        own = np.empty(len(served.keys), bool)
        own[served.rank] = np.isin(served.keys, model.classes.keys)
        assert len(served.keys) > len(model.classes.keys) and (served.word < 1e-9).all()
        for k in range(pitman_yor.TOP + 1, 32):
            mine = (served.kind[32:] == k) & ~own
            assert math.isclose(10 ** served.word[k] + (10 ** served.word[32:][mine]).sum(), 1, rel_tol=1e-9)


def test_events_of_long_rows_and_small_chunks(monkeypatch):
    text = ["one", "two three, four. " * 30, "", "x" * 300 + " the end", "a b", " ".join(WORDS)]
    data = np.frombuffer("".join(text).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, text)])
    held = np.array([False, True, False, True, False, True])
    classes = pitman_yor.WordClasses(np.empty(0, np.int64))

    def found(parts):
        chunk, batches, piece, before = word_contexts.Chunk(5, parts), [], 0, (0, 0)
        for i, j, h, kinds, at, key, off in pitman_yor.class_pieces(Hasher(), classes, data, offsets):
            close = off[-1] > len(h)
            word, dish = np.zeros((2, off[-1]), np.int64)
            place = np.arange(len(h)) + close * np.repeat(np.arange(j - i), np.diff(at))
            code = word_contexts.codes(h.view(np.int64), h.view(np.int64) % 3 == 0, h.view(np.int64) >> 44 & 0xFFFFF)
            word[place], dish[place] = code, kinds
            batches += chunk.add(np.arange(i, j), held[i:j], piece, word, dish, key >> 5, off, before)
            piece, before = (0, (0, 0)) if close else (piece + 1, (*code[:-3:-1].tolist(), *before)[:2])
        batches += chunk.flush()
        out, rows = [], {}
        for b in batches:
            for part, number, kind, x in zip(*(c.to_pylist() for c in b.columns)):
                if kind == word_contexts.OF_ROWS:
                    rows[number] = word_contexts.unpacked(x, word_contexts.ROW_FIELDS)[0]
        for b in batches:
            for part, number, kind, x in zip(*(c.to_pylist() for c in b.columns)):
                if kind == word_contexts.OF_EVENTS:
                    g, before_kinds, child, dish, out_of_training, row = word_contexts.unpacked_events(x)
                    assert (g.astype(float) * parts / 2.0**64).astype(int).tolist() == [part] * len(g)
                    assert (out_of_training == held[rows[number][row]]).all()
                    out += zip(g.tolist(), before_kinds.tolist(), child.tolist(), dish.tolist(), rows[number][row].tolist())
        return sorted(out)

    whole = found(1)
    assert len(whole) == 2 + 91 + 1 + 4 + 3 + 121 and found(7) == whole
    monkeypatch.setattr(word_contexts, "CHUNK_EVENTS", 10)
    monkeypatch.setattr(word_contexts, "ROWS", 2)
    monkeypatch.setattr(textbytes, "GROUP_BYTES", 40)
    monkeypatch.setattr(textbytes.groups, "__defaults__", (40,))
    assert found(1) == whole and found(3) == whole


@pytest.mark.parametrize("n", [0, 1, 16, 5000])
def test_places_of_hashes_among_keys(n):
    r = np.random.default_rng(n)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    close = r.integers(1 << 40, (1 << 40) + 3 * n + 1, n)  # all in one range of hashes
    for keys in (r.integers(low, high, n), close, np.concatenate([[low, -1, 0, high], close])):
        keys = np.unique(keys)
        h = np.concatenate([keys, keys + 1, keys - 1, r.integers(low, high, 3000), [low, -1, 0, 1, high]])
        place, found = textbytes.Places(keys).find(h)
        assert (found == np.isin(h, keys)).all()
        assert (keys[place[found]] == h[found]).all() and (not len(keys) or place.max() < len(keys))
        assert not len(textbytes.Places(keys).find(h[:0])[0])


@pytest.mark.parametrize("held", [1, 7, 400_000])
def test_words_are_counted_whatever_a_task_holds(spark, monkeypatch, held):
    """Groups of texts are added up in arrays; a task passes on what is above its bound."""
    monkeypatch.setattr(pitman_yor, "HELD", held)
    monkeypatch.setattr(textbytes.groups, "__defaults__", (40,))
    texts = ["Ba ba bo", None, "", " \n", "bo " * 30, "bi\tBI bu ba", "bu"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    words = [w for t in texts for w in (t or "").lower().split()]
    got = {r["key"]: r["n"] for r in pitman_yor.word_counts(rows).collect() if r["kind"] != pitman_yor.END}
    data = np.frombuffer(" ".join(sorted(set(words))).encode(), np.uint8)
    keys = Hasher().words(data, np.empty(0, np.int64))[0].view(np.int64).tolist()
    assert got == {k: words.count(w) for k, w in zip(keys, sorted(set(words)))}
    kind, key, n = pitman_yor.summed(np.array([5, 6, 5]), np.array([9, -3, 9]), np.array([4, 2, 1]))
    assert (kind.tolist(), key.tolist(), n.tolist()) == ([6, 5], [-3, 9], [2, 5])
