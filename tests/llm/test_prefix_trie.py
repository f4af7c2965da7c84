"""The conversation prefix trie (13) against a plain trie of Python dicts."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import prefix_trie as T
from tidemark.plans import scan as scan_mod

WORD = re.compile(r"[^ \t-\r]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth string, weight string, f1 string, rep string"


def brute(rows):
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in original.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(of) - 1) * words
    return sorted(
        (min(of), len(n), min(members[n[:-1]]) if n else -1, len(of), kids[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, of in members.items()
    )


def rows_of(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.select(*cols).collect())


def conversations():
    r = random.Random(5)
    rows = []
    for c in r.sample(range(400), 150):
        for t in range(r.choice([1, 1, 2, 5, 9])):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "user", None]), r.choice(["a b", " c\n", "", None, "d e f"])))
    seen, kept = set(), []
    for row in rows:  # one row per (conv, turn): the order of equal turns is the operator's own
        if (row[0], row[1]) not in seen:
            seen.add((row[0], row[1]))
            kept.append(row)
    # a hot conversation that holds a third of all rows, and copies of it
    kept += [(1000 + k, t, "user", f"w{t % 7} x") for k in (0, 1, 25, 60) for t in range(200)]
    kept += [(2000 + 20 * k, t, "user", "same text") for k in range(60) for t in range(3)]
    return kept


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(5)


ROWS = conversations()


def test_trie_equals_brute_force(spark):
    assert rows_of(T.prefix_trie(frame(spark, ROWS))) == brute(ROWS)


def test_split_components_hot_conversations_and_long_lists(spark, monkeypatch):
    """Small bounds: rounds of joins, bucketed scans, ids in many strings."""
    monkeypatch.setattr(T, "CHUNK_IDS", 4)
    monkeypatch.setattr(scan_mod, "DIRECT_MAX_ROWS", 100)
    assert rows_of(T.prefix_trie(frame(spark, ROWS), local_rows=120)) == brute(ROWS)


def test_batches_of_components(spark, monkeypatch):
    monkeypatch.setattr(T, "LOCAL_ROWS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows_of(T.prefix_trie(frame(spark, ROWS))) == brute(ROWS)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_turnless_repeated_null_and_empty(spark):
    # conversation 21 loses its only turns, as its block's first one is absent
    gone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(gone, 0, "user", "only"), (gone, 1, "user", "two"), (5, 1, "u", "x"), (5, 1, "u", "x"), (None, 0, "u", "lost")]
    assert rows_of(T.prefix_trie(frame(spark, rows))) == brute(rows)
    assert rows_of(T.prefix_trie(frame(spark, [(gone, 0, "user", "only")]))) == brute([(gone, 0, "user", "only")])
    assert T.prefix_trie(frame(spark, [(None, 0, "u", "x")])).count() == 0
    assert T.prefix_trie(frame(spark, ROWS).limit(0)).count() == 0


@pytest.mark.parametrize("near", [1, 8, 50])
def test_centroid_sums_equal_sums_from_below(near):
    r = np.random.default_rng(near)
    for _ in range(60):
        n = int(r.integers(1, 80))
        parent = np.array([-1 if i == 0 or r.random() < 0.1 else int(r.integers(max(0, i - near), i)) for i in range(n)])
        depth = np.ones(n, int)
        for i in range(n):
            if parent[i] >= 0:
                depth[i] = depth[parent[i]] + 1

        def below(v):
            out = v.copy()
            for i in range(n - 1, -1, -1):
                if parent[i] >= 0:
                    out[parent[i]] += out[i]
            return out

        values = r.integers(0, 9, (n, 2))
        assert (T.centroid_sums(parent, depth, below(r.integers(1, 5, n)), values) == below(values)).all()
