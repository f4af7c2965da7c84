"""BPE (11) and cross-tokenizer alignment (12) against the public tokenizer libraries."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import bpe, merges, token_align
from tidemark.llm.packing import BYTE_BPE, tokenizer_path

A, B = tokenizer_path(BYTE_BPE), tokenizer_path(token_align.PIECE_BPE)
R = random.Random(11)
TEXTS = [
    None, "", " ", "  ", "a ", " a", "aaaa", "  a  b\n\n", "<|endoftext|>x <|endoftext|><|endoftext|> <s></s>", " don't we'll ",
    "\x1c\x1d a\x85　", "a\x00b\r\n", "a▁b", "é漢😀 x ﬁ é", "x" * 5000, "\n\n a  b", "<0x41> <unk>",
    *("".join(R.choices("abcdef  \n'é漢0😀", k=R.randrange(3000))) for _ in range(40)),
    " ".join("".join(R.choices("etaoinshrdlu", k=R.randrange(1, 12))) for _ in range(30_000)),
]
SCHEMA = "doc_id long, text string, ids string, n_tokens string, pairs string, pair string, n string, n_a string"


def table(spark):
    rows = [(k, t, "x", "x", "x", "x", "x", "x") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[-2], (None, TEXTS[-3], *"xxxxxx")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(A)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(A, bpe.unsettled_letters())


def same_as_library(own, library, texts):
    for text, got, want in zip(texts, own.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids, text[:80]
        assert own.decode(got) == library.decode(want.ids, skip_special_tokens=False)


def test_ids_and_text_equal_the_library(own, library):
    same_as_library(own, library, [t or "" for t in TEXTS])


def test_every_character_equals_the_library(own, library):
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]]
    same_as_library(own, library, ["".join(f"a{c}1{c} " for c in chars[k : k + 4096]) for k in range(0, len(chars), 4096)])


def test_long_words_by_rank_equal_rounds(own, library):
    words = ["".join(R.choices("etaoinshrdlu", k=9000)), "a" * 7001, "ab" * 4000, "é" * 3000, "ha" * 1500 + "h" * 1501]
    assert own.merges.ordered and all(len(w) > merges.LONG_BYTES for w in words)
    for w in words:
        data = w.encode()
        ids = np.concatenate([i for _, i in own.merges._rounds([data], np.array([0]))])
        assert own.merges._by_rank(data).tolist() == ids.tolist()
    same_as_library(own, library, words)


def test_pieces_and_a_full_cache_change_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_CHARS", 50)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    same_as_library(own, library, [t or "" for t in TEXTS[:-1]] + [TEXTS[-1][:20_000]])


def test_bytes_that_are_no_text_decode_like_the_library(own, library):
    ids = [library.token_to_id(c) for c in "âĢĺðŁ"] + [50256, library.token_to_id("Ã")]
    assert own.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_op11_digests_and_documents(spark, library):
    docs = table(spark)
    got = bpe.digests(docs, A).collect()
    assert len(got) == len(TEXTS) + 2
    want = {}
    for k, t in [*enumerate(TEXTS), (None, TEXTS[-3])]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), text.encode())]
        want[k] = (len(ids), *sha)
    for row in got:
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == want[row["doc_id"]]
    whole = bpe.decode_documents(bpe.encode_documents(docs, A), A).collect()
    assert all(r["decoded"] == (r["text"] or "") and r["n_tokens"] == "x" for r in whole)
    assert bpe.digests(docs.limit(0), A).count() == 0


def brute_links(library, model, text):
    """Tokens and links of one text by its sets of byte ends."""
    library.encode_special_tokens = True
    bytes_a, bytes_b = merges.Merges(A).token_bytes if not CACHE else CACHE[0], token_align.piece_bytes(model) if not CACHE else CACHE[1]
    CACHE[:] = [bytes_a, bytes_b]
    a = library.encode(" " + text, add_special_tokens=False).ids
    b = model.encode(text)
    library.encode_special_tokens = False
    data = (" " + text).encode()
    if not text or b"".join(bytes_a[i] for i in a) != data or b"".join(bytes_b[i] for i in b) != data:
        return [], [], [], ""
    ends = []
    for ids, of in ((a, bytes_a), (b, bytes_b)):
        at, out = 0, {}
        for k, i in enumerate(ids):
            at += len(of[i])
            out[at] = k
        ends.append(out)
    links = [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]
    groups, x, y = [], 0, 0
    for i, j in links:
        groups.append(",".join(map(str, a[x : i + 1])) + "|" + ",".join(map(str, b[y : j + 1])))
        x, y = i + 1, j + 1
    return a, b, links, ";".join(groups)


CACHE: list = []


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


def test_alignment_equals_sets_of_byte_ends(spark, library, model, monkeypatch):
    docs = table(spark)
    pairs = token_align.vocabulary_pairs(A, B)
    assert len(pairs.keys) <= pairs.bound
    aligned = token_align.cut(token_align.align_documents(docs, A, B, pairs))
    got = token_align.score_links(aligned, pairs).collect()
    assert len(got) == len(TEXTS) + 2
    rows = [(k, TEXTS[k] if k is not None else TEXTS[-3]) for k in (r["doc_id"] for r in got)]
    found = [brute_links(library, model, t or "") for _, t in rows]
    counts = Counter((a[i], b[j]) for a, b, links, _ in found for i, j in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    assert sum(1 for a, _, _, _ in found if not a) >= 3  # null, empty, U+2581
    for row, (a, b, links, groups) in zip(got, found):
        of = [(a[i], b[j]) for i, j in links]
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == (
            len(a), len(b), len(links), len(links), sha)
        assert row["n_best"] == sum(counts[p] == best[p[1]] for p in of)
        assert row["count_sum"] == sum(counts[p] for p in of)
    assert token_align.score_links(token_align.cut(token_align.align_documents(docs.limit(0), A, B, pairs)), pairs).count() == 0


def test_lanes_change_nothing(model, library, monkeypatch):
    aligner = token_align.Aligner(A, B, bpe.unsettled_letters())
    texts = [t or "" for t in TEXTS[:-1]]
    wide = aligner.align(texts)
    monkeypatch.setattr(token_align, "LANE_CHARS", 3)
    for x, y, t in zip(wide, aligner.align(texts), texts):
        a, b, links, groups = brute_links(library, model, t)
        assert all(np.array_equal(p, q) for p, q in zip(x, y))
        assert (x[0].tolist(), x[1].tolist(), list(zip(x[2].tolist(), x[3].tolist())), aligner.groups(*x)) == (a, b, links, groups)
