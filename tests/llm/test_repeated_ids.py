"""A doc_id with several texts: stages judge rows, not ids; the pipeline on such tables and on an empty one."""

import itertools
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import bitplane, exact_dedup, langid, near_dedup, packing
from tidemark.llm.bitplane import from_planes, to_planes
from tidemark.llm.common import cut, split_by_ids
from tidemark.llm.packing import tokenizer_path
from tidemark.llm.tokens import LOWER_PARTS, SPACED_PARTS, Encoder
from tidemark.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, own_id string"
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, "alpha beta"), (5, "alpha  beta"), (5, "a unique clean text"), (7, LONG), (8, LONG + " more"), (8, "other words here"),
    (9, None), (9, "only nine"), (9, "only nine"), (None, "no id"), (3, LONG + " more"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x") for i, t in ROWS], SCHEMA).repartition(3)


def pairs(df):
    return sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in df.collect()))


def rows_without(*gone):
    return sorted((i if i is not None else -1, t or "") for i, t in ROWS if (i, t) not in gone)


def test_exact_dedup_drops_copies_and_no_other_text(spark, docs):
    kept = exact_dedup.first_copies(docs, exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index")))
    assert pairs(kept) == rows_without((5, "alpha  beta"), (8, LONG + " more"))


def test_near_dedup_links_texts_and_not_ids(docs):
    found = {}
    for r in near_dedup.near_duplicates(docs, 80).collect():
        found.setdefault(r["doc_id"], []).append((r["component_id"], r["n_shingles"], r["kept"]))
    assert found[5] in ([(1, 1, False), (5, 1, True)], [(5, 1, True), (1, 1, False)])
    assert sorted(found[8]) == [(3, 11, False), (8, 1, True)] and found[7] == [(3, 10, False)] and found[3] == [(3, 11, True)]
    assert sorted(found[9]) == [(9, 0, True), (9, 1, True), (9, 1, True)] and found[None] == [(None, 1, True)]
    kept = near_dedup.one_of_each(docs, 80)
    assert kept.columns == docs.columns
    assert pairs(kept) == rows_without((5, "alpha  beta"), (8, LONG + " more"), (7, LONG))


def test_rows_are_split_by_ids(spark):
    table = spark.range(20_000).selectExpr("IF(id % 1000 = 7, NULL, id) AS id", "'t' AS text")
    for ids, extra in ((range(0, 3000, 3), 0), ([*range(0, 3000, 3), None], 20), ([], 0)):
        wanted = cut(spark.createDataFrame([(i,) for i in ids], "k long"))
        some, others = split_by_ids(table, "id", wanted)
        hit = {i for i in ids if i is None or i % 1000 != 7}
        rest = [r["id"] for r in others.collect()]
        assert some.columns == table.columns and not hit & set(rest) and hit <= {r["id"] for r in some.collect()}
        assert some.count() + len(rest) == 20_000 and some.count() <= len(ids) + extra + 200


@pytest.mark.parametrize("stage", [exact_dedup, near_dedup])
def test_rows_that_stay_are_not_shuffled(spark, monkeypatch, stage):
    texts = [" ".join(f"w{k}x{j}" for j in range(9)) for k in range(300)] + [" ".join(f"w5x{j}" for j in range(9)) + " " * k for k in (0, 1)]
    table = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    parts, split = [], stage.split_by_ids
    monkeypatch.setattr(stage, "split_by_ids", lambda *a: parts.append(split(*a)) or parts[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if stage is exact_dedup:
            kept = exact_dedup.first_copies(table, exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index")))
        else:
            kept = near_dedup.one_of_each(table, 80)
        assert {r["doc_id"] for r in kept.collect()} == set(range(302 if stage is exact_dedup else 300)) - {300}
        ((some, others),) = parts
        assert some.count() <= 4 and others.count() >= 298
        plan = spark._jvm.PythonSQLUtils.explainString(others._jdf.queryExecution(), "formatted")
        assert "BroadcastHashJoin" in plan and not re.search(r"\) Exchange\nInput[^\n]*text", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_language_rejects_rows_and_not_ids(spark):
    clean = ["the cat sat on the mat and the dog ran over the hill to the river bank again"] * 6
    rows = [(k, t + f" {k}", "en", "s", 0, "x") for k, t in enumerate(clean)]
    rows += [(2, "zqxj vkwq pfzx jjqz wvxk qqzj xkcv bzqw mxzj qvkx zzqj kwxv " * 4, None, "s", 0, "x")]
    table = spark.createDataFrame(rows, SCHEMA)
    kept = langid.known_language(table)
    assert kept.columns == table.columns and {r["text"] for r in kept.collect()} >= {r[1] for r in rows[:6]}
    assert kept.count() == 6


def test_pipeline_keeps_every_text_that_no_stage_drops(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").count().collect()
    want = [i for i, t in rows_without((5, "alpha  beta"), (8, LONG + " more"), (7, LONG))]
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["count"]) for r in got) == sorted((i, want.count(i)) for i in set(want))


def test_pipeline_on_an_empty_table(spark, docs, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns)


def test_lower_cased_parts_give_whole_text_ids():
    import random

    import numpy as np
    from tokenizers import Tokenizer

    r, path = random.Random(3), tokenizer_path("word_bpe_49k.json")
    texts = ["".join(r.choices("aAbBàÀßéÉÿŸ×÷µªº\u0301IİΣσ'sStT<|>  \n.,!9é́漢", k=r.randrange(200))) for _ in range(1500)]
    texts += ["<|endoftext|> <|ENDOFTEXT|> Don'T", "İ Ķ", "Don'T X''s a'b 'S'T", ""]
    want = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert list(Encoder(path, "", parts=LOWER_PARTS).ids(texts)) == want
    assert list(Encoder(path, "", 50, LOWER_PARTS).ids(texts)) == want
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n).astype("<u4")
        assert (from_planes(to_planes(ids), n) == ids).all()


def test_plain_texts_share_parts_whatever_stands_around_words():
    from tokenizers import Tokenizer

    r = random.Random(21)
    alphabet = ["a", "The", "é", "ÖÄß", "ÿ", " ", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "'s", "'LL", "'", "1", "23", ".", "...", "|>", "~"]
    plain = ["".join(r.choices(alphabet, k=r.randrange(40))) for _ in range(3000)] + ["", " ", "\n"]
    other = ["<|endoftext|> a", "a × b", "\x1c a", "é", "\xa0a", "ст " * 5, "x " * (1 << 20) + "a.\n\nb"]
    mixed = [t for pair in zip(plain, itertools.cycle(other[:-1])) for t in pair] + other
    for name, lead, kw in ((packing.BYTE_BPE, " ", {"spaced": SPACED_PARTS}), (bitplane.WORD_BPE, "", {"parts": LOWER_PARTS})):
        path = packing.tokenizer_path(name)
        library = Tokenizer.from_file(path)
        for texts, words in ((plain, 200_000), (mixed, 5)):
            want = [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
            encoder = Encoder(path, lead, words, **kw)
            assert list(encoder.ids(texts)) == want
            assert texts is mixed or not encoder.rest.young
        encoder = Encoder(path, lead, **kw)
        list(encoder.ids(["x end. end, end\nend; end! (end", "y end"]))
        assert sum("end" in w for w in encoder.parts.young) <= 2  # with and without a space
