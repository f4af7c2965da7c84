"""Each operator against brute force on small tables with nulls, ties, copies and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann, bitplane, exact_dedup, html_extract, langid, mixing, near_dedup, packing, pii, pitman_yor, textbytes
from tidemark.llm.textbytes import Hasher
from tidemark.llm.tokens import Encoder
from tidemark.session import scratch_path

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^ \t-\r]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string, rank long"


def make_docs():
    r = random.Random(4)
    words = ["the", "of", "and", "Tion", "ndst", "erly", "über", "que", "a.b@c.de", "10.0.0.1", "+1 555 0100 222", "4111 1111 1111 1111"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([3, 30, 120]))) for _ in range(40)]
    texts += [texts[7], texts[7] + "  ", texts[9].replace(" ", "\n"), "", None, " \t", "one", texts[12][:-6] + " changed end"]
    texts.append(" ".join(r.choice(words) for _ in range(4000)))
    base = texts[1].split(" ") * 3
    for k in range(12):
        copy = list(base)
        copy[(k * 7) % len(copy)] = f"edit{k}"
        texts.append(" ".join(copy))
    return [(i, t, r.choice(["en", None]), r.choice(["s0", "s0", "s1", None]), 0, None, "x", 1) for i, t in enumerate(texts)]


DOCS = make_docs()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_components(percent):
    sets = {d[0]: shingles(d[1]) for d in DOCS}
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            inter = len(sets[a] & sets[b])
            if a < b and inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in sets}


def base_spans(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            ok = kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
            ok = ok or (kind == "card" and 12 <= len(digits) <= 19 and luhn) or (kind == "phone" and 9 <= len(digits) <= 15)
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_pii_base_spans(spark, docs, empty):
    r = random.Random(5)
    alphabet = [*"ab.@-+ %_0123456789()é", "12.3.4.5", "4111 1111 1111 1111", "+1 (743) 555-3824", "a.b@c.de", "\U0001f600"]
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.randrange(60)))) for i in range(300)] + [(900, None)]
    for table, want in ((spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)), (docs, {d[0]: d[1] for d in DOCS})):
        got = pii.spans(table).select("doc_id", pii._listing("base").alias("b")).collect()
        assert {g["doc_id"]: g["b"] for g in got} == {i: ",".join(base_spans(t)) for i, t in want.items()}
    assert pii.spans(empty).count() == 0


def test_pii_disclosing_terms(spark):
    rows = [(i, f"{w} zebulon writes from bob@x.example today") for i, w in enumerate(["we", "they", "you", "she"])]
    rows += [(10 + i, f"nothing here today number {i}") for i in range(40)]
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "zebulon" not in out[0] and "[EMAIL]" in out[0] and "today" in out[0] and out[10] == rows[4][1]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup_equals_all_pairs(docs, percent):
    sets, want = near_components(percent)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs, percent).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(s) and got[i]["kept"] == (want[i] == i) for i, s in sets.items())


def test_near_dedup_empty(empty):
    assert near_dedup.near_duplicates(empty, 85).count() == 0


def test_sketch_registers_merge_and_estimate():
    r = np.random.default_rng(1)
    x = r.integers(0, 2**63, 3000).astype(np.uint64)
    whole, a, b = (near_dedup.registers_of(np.sort(p), np.array([0, len(p)]), 512)[0] for p in (x, x[:2000], x[1000:]))
    assert (np.maximum(a, b) == whole).all()
    more, less = (a > b).sum(), (a < b).sum()
    one = lambda v: np.array([float(v)])
    args = one(more), one(less), one(512 - more - less), one(2000), one(2000)
    assert near_dedup.likely(*args, 0.34)[0] and not near_dedup.likely(*args, 0.85)[0]


def test_word_cache_gives_whole_text_ids():
    from tokenizers import Tokenizer

    r = random.Random(3)
    alphabet = [*"ab Z9.,'é́ßΣ \n\t \xa0\x85<|>", "<|endoftext|>", "'s", "  ", " \n", "\n "]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(25))) for _ in range(4000)] + ["", " "]
    for name, lead in ((packing.BYTE_BPE, " "), (bitplane.WORD_BPE, "")):
        path = packing.tokenizer_path(name)
        want = [np.asarray(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        assert list(Encoder(path, lead).ids(texts)) == want


def ids_of(name, text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(packing.tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_packing_is_gapless_and_tight(spark, docs, empty):
    got = packing.op3_packing(spark, "", docs).collect()
    by_doc, bins = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, text, *_ in DOCS:
        ids = ids_of(packing.BYTE_BPE, text)
        own = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == 1024 for r in own[1:]) and sum(r["length"] for r in own) == len(ids)
        assert all(crc(ids[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for r in own)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 1024) + 2
    assert packing.op3_packing(spark, "", empty).count() == 0


def test_packing_in_multiples():
    r = np.random.default_rng(2)
    histogram = dict(Counter(r.integers(1, 1024, 20_000).tolist()))
    table, levels, sequences = packing.places(histogram, steps=1000)
    assert levels == [64, 8, 1]
    bound = -(-sum(k * v for k, v in histogram.items()) // 1024)
    assert sequences <= 1.05 * bound
    assert len(set(zip(table["size"].tolist(), table["chunk"].tolist()))) == len(table["size"])


def test_id_files_round_trip(spark, docs, empty):
    manifest = bitplane.write_ids(docs, scratch_path(spark, "t-ids"), packing.tokenizer_path(bitplane.WORD_BPE))
    start = {r["shard"]: r for r in manifest.collect()}
    got = sorted(bitplane.read_documents(manifest).collect(), key=lambda r: (r["shard"], r["local_start"]))
    assert [r["doc_id"] for r in got] == [d[0] for d in DOCS]
    assert all(r["ids_crc32"] == crc(ids_of(bitplane.WORD_BPE, d[1])) for r, d in zip(got, DOCS))
    first = got[0]
    reader = bitplane.ShardReader(start[first["shard"]]["path"])
    assert reader.ids(0, first["n_tokens"]).tolist() == ids_of(bitplane.WORD_BPE, DOCS[0][1])
    assert bitplane.write_ids(empty, scratch_path(spark, "t-ids"), packing.tokenizer_path(bitplane.WORD_BPE)).count() == 0


def test_bit_planes_round_trip():
    for n in (1, 7, 65_536):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        assert (bitplane.from_planes(bitplane.to_planes(ids), n) == ids).all()


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>menu</ul></nav><div class='ad'>buy</div>{}"
    "<div class='comments'><p>reader</div></article><footer>&copy; f</footer></body></html>"
)


def test_html_main_text(spark):
    article = "<article><h1>A &amp;  B</h1><p><b>one<br>two<p>three</p><script>var t='</p>'</script><aside>side</aside>"
    page = PAGE.replace("{}", article)
    assert html_extract.extract(page) == "A & B\none two\nthree"
    post = "<div class='post'><h2>T</h2><p>x<p>y</div>"
    other = PAGE.replace("</article>", "").replace("{}", post)
    rows = [(i, "http://a.example/x", page, "e") for i in range(3)]
    rows += [(10 + i, "http://b.example/", other, "e") for i in range(2)] + [(20, None, None, "e"), (21, "x", "", "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages).collect()}
    assert got[0] == "A & B\none two\nthree" and got[10] == "T\nx\ny" and got[20] == got[21] == ""
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_wrapper_alignment():
    one, two = (html_extract.signature(f"<body><h1>t</h1>{x}</body>") for x in ("<p>a", "<ul><li>1<li>2</ul><p>a<p>b"))
    wrapper = html_extract.align(one, two)
    assert ("+", ("p", "#", "/p")) in wrapper and any(n[0] == "?" for n in wrapper if isinstance(n, tuple))
    assert html_extract.align(wrapper, two) == wrapper


def test_mixing_keeps_each_source_within_a_block(spark, docs, empty):
    rows = [(i, "abcd"[(i % 7 > 2) + (i % 7 > 4) + (i % 7 > 5)]) for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"a": 0.45, "b": 0.3, "c": 0.15, "d": 0.1}
    targets = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = mixing.mix(table, targets, block_rows=8, frame_slots=100).collect()
    assert len(got) == 4000 and len({(r["slot"], r["place"]) for r in got}) == 4000
    blocks = sorted({(r["slot"], r["source"]) for r in got if r["selected"]})
    seen = Counter()
    for n, (slot, source) in enumerate(blocks):
        seen[source] += 1
        if n < len(blocks) - 20:  # at the very end used-up sources leave slots empty
            assert slot == n
            assert all(abs(seen[s] - w * (n + 1)) < 1 for s, w in weights.items())
    assert mixing.mix(docs).count() == len(DOCS) and mixing.mix(empty).count() == 0


def test_nearest_reaches_recall(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((3000, 24))
    x[100:140] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(5000, None, 0), (5050, [0.0] * 24, 0), (5100, [float("nan")] * 24, 0), (5150, [1.0], 0), (None, x[0].tolist(), 0)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int"), 50).collect()
    found = {}
    for g in got:
        found.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        c = unit @ unit[q]
        c[q] = -9
        own = sorted(found[q])
        assert [k for k, _, _ in own] == [1, 2, 3, 4, 5] and all(abs(c[v] - s) < 1e-12 for _, v, s in own)
        hit += len({v for _, v, _ in own} & set(np.lexsort((np.arange(3000), -c.round(12)))[:5].tolist()))
    assert hit >= 0.9 * 5 * 60 and set(found) == set(range(0, 3000, 50))
    assert [v for _, v, _ in sorted(found[100])] == [101, 102, 103, 104, 105]


def test_nearest_in_tiny_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert ann.nearest(spark.createDataFrame([], schema), 50).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema)
    assert [r["vec_id"] for r in ann.nearest(three, 50).orderBy("rank").collect()] == [2, 1]


@pytest.mark.parametrize("head", [pitman_yor.HEAD, 3])
def test_unigram_base_and_model(docs, monkeypatch, head):
    monkeypatch.setattr(pitman_yor.head_words, "__defaults__", (head,))
    train, c = [d for d in DOCS if zlib.crc32(str(d[0]).encode()) % 7 != 2], Counter()
    words = {d[0]: WORD.findall((d[1] or "").translate(LOWER)) for d in DOCS}
    for d in train:
        c.update(words[d[0]])
    n, v = sum(c.values()) + len(train), len(c) + 1
    got = pitman_yor.score(docs).collect()
    assert len(got) == len(DOCS)
    for r in got:
        w = words[r["doc_id"]]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        assert math.isclose(base, r["base_score"], rel_tol=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(c[x] > 0 for x in w) + 1, n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) and r["score"] < 0


def test_class_model_is_a_distribution(empty):
    r = np.random.default_rng(5)
    n = np.where(r.random((32, 32, 32)) < 0.05, r.integers(1, 500, (32, 32, 32)), 0).astype(float)
    p, sent = pitman_yor.sample_group(n, np.full(32, 1 / 32), 1)
    assert np.allclose(p.sum(-1), 1) and sent.sum() >= 1
    assert pitman_yor.score(empty).count() == 0


@pytest.mark.parametrize("head", [pitman_yor.HEAD, 3])
def test_model_scores_equal_brute_force(docs, monkeypatch, head):
    monkeypatch.setattr(pitman_yor.head_words, "__defaults__", (head,))
    train, c = [d for d in DOCS if zlib.crc32(str(d[0]).encode()) % 7 != 2], Counter()
    words = {d[0]: WORD.findall((d[1] or "").translate(LOWER)) for d in DOCS}
    for d in train:
        c.update(words[d[0]])
    rows = docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 7 != 2")
    model = pitman_yor.fit(rows, pitman_yor.word_counts(rows))
    assert np.allclose((10**model.grams).reshape(-1, 32).sum(1), 1, atol=1e-4)
    hashes = Hasher()

    def kind(word):
        data = np.frombuffer(word.encode(), np.uint8)
        h, _, ends = hashes.words(data, np.array([0, len(data)]))
        return int(model.classes.of(data, h.view(np.int64), ends)[0])

    kinds = {w: kind(w) for own in words.values() for w in own}
    seen, total = {}, 0
    for w, n in c.items():
        seen.setdefault(kinds[w], []).append(n)
    for k, sizes in seen.items():  # known words and the new ones of a class sum to one
        d, room = model.discount[k], sum(sizes) + pitman_yor.WORD_STRENGTH
        if k <= pitman_yor.TOP:
            assert len(sizes) == 1
        else:
            assert math.isclose(10 ** model.new[k] + sum(n - d for n in sizes) / room, 1, rel_tol=1e-9)
    for r in pitman_yor.score(docs).collect():
        before, want = (0, 0, 0), 0.0
        for w in [*words[r["doc_id"]], None]:
            k = kinds[w] if w else 0
            want += model.grams[(before[2] << 15) | (before[1] << 10) | (before[0] << 5) | k]
            if k > pitman_yor.TOP:
                want += math.log10(c[w] - model.discount[k]) - model.room[k] if c[w] else model.new[k]
            before = (k, *before[:2])
        total += want
        assert math.isclose(want, r["score"], rel_tol=1e-6)
    assert total < 0


def test_classes_before_pass_from_piece_to_piece(monkeypatch):
    text = ["one", "two three, four. " * 30, "", "x" * 300 + " the end", "a b"]
    data = np.frombuffer("".join(text).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, text)])

    def keys():
        out = {}
        for i, j, _, _, _, key, off in pitman_yor.class_pieces(Hasher(), pitman_yor.WordClasses(np.empty(0, np.int64)), data, offsets):
            for k in range(j - i):
                out.setdefault(i + k, []).extend(key[off[k] : off[k + 1]].tolist())
        return out

    whole = keys()
    monkeypatch.setattr(textbytes, "GROUP_BYTES", 40)
    monkeypatch.setattr(textbytes.groups, "__defaults__", (40,))
    assert keys() == whole and [len(whole[k]) for k in range(5)] == [2, 91, 1, 4, 3]


def test_model_beats_the_unigram_base_on_held_out_texts(spark):
    got = pitman_yor.op8_pitman_yor(spark, "/root/testdata/sf0.01").filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got["s"] > got["b"]


def test_exact_dedup_and_persistent_index(spark, docs, empty):
    norm = lambda t: re.sub(r"[ \t-\r]+", " ", t or "")
    first = {}
    for d in DOCS:
        first.setdefault(norm(d[1]), d[0])
    size = Counter(norm(d[1]) for d in DOCS)
    path = scratch_path(spark, "t-index")
    got = exact_dedup.exact_duplicates(docs, exact_dedup.DigestIndex(spark, path)).collect()
    for r in got:
        text = norm(DOCS[r["doc_id"]][1])
        assert (r["keep_id"], r["group_size"], r["kept"]) == (first[text], size[text], first[text] == r["doc_id"])
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    again = exact_dedup.DigestIndex(spark, path)  # a later batch, against the same files
    later = spark.createDataFrame([(900, DOCS[3][1]), (901, "new text")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in exact_dedup.exact_duplicates(later, again).collect()} == {900: False, 901: True}
    assert exact_dedup.exact_duplicates(empty, exact_dedup.DigestIndex(spark, scratch_path(spark, "t-index"))).count() == 0


def test_language_held_out_accuracy(spark, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table.filter("doc_id % 2 = 0"))
    rows = langid.evidence(table.filter("doc_id % 2 = 1")).withColumn("declared", F.lit(None).cast("string"))
    want = {r["doc_id"]: r["lang"] for r in table.select("doc_id", "lang").collect()}
    got = langid.identify(rows, model).collect()
    assert len(got) == 500 and all(r["kept"] for r in got)
    assert sum(want[r["doc_id"]] == r["lang"] for r in got) >= 0.97 * len(got)
    r = random.Random(6)
    junk = [(i, "s0", None, "".join(r.choice("qxzjkvwbg") for _ in range(600))) for i in range(5)]
    out = langid.identify(spark.createDataFrame(junk, "doc_id long, host string, declared string, text string"), model)
    assert not any(r["kept"] for r in out.collect())
    assert langid.identify(langid.evidence(empty), langid.fit(empty)).count() == 0


def test_pipeline_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, "")
        assert kept.columns == docs.columns
    norm = lambda t: re.sub(r"[ \t-\r]+", " ", t or "")
    first = {}
    for d in DOCS:
        first.setdefault(norm(d[1]), d[0])
    _, label = near_components(80)
    # copies are gone before the near-copies are compared; components of the rest are the same
    want = {i for i in first.values() if label[i] == i or label[i] not in first.values()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == want


def test_mixture_without_targets_keeps_every_row(spark):
    rows = [(i // 2, "hot" if i % 10 < 8 else "cold") for i in range(2000)] + [(None, "hot"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    assert Counter(map(tuple, mixing.mixture(table).collect())) == Counter(rows)
    assert all(r["selected"] for r in mixing.mix(table).collect())


def test_packed_sequences_follow_the_mixture(spark):
    rows = [(i // 2, f"word {i} " * (i % 40), "hot" if i % 10 < 8 else "cold", "x") for i in range(600)] + [(None, None, None, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, slot string").repartition(3)
    mixed = corpus_pipeline.mix(spark, table, "")
    assert Counter(tuple(r)[:4] for r in mixed.collect()) == Counter(rows)
    slots = {(r["mix_slot"], r["mix_place"]): r["source"] for r in mixed.collect()}
    assert len(slots) == len(rows)
    got = corpus_pipeline.pack(spark, mixed, "").collect()
    assert {(r["mix_slot"], r["mix_place"]) for r in got} == set(slots)
    first, held = {}, Counter()
    for r in got:
        at = (r["mix_slot"], r["mix_place"])
        first[r["sequence_id"]] = min(first.get(r["sequence_id"], at), at)
        held[r["sequence_id"]] += r["length"]
    assert sorted(first) == list(range(len(first))) and len(first) > 5 and max(held.values()) <= 1024
    assert [first[k] for k in sorted(first)] == sorted(first.values())  # sequences start in the order of the schedule
    plain = corpus_pipeline.packing.op3_packing(spark, "", mixed).collect()
    assert len({r["sequence_id"] for r in plain}) == len(first)  # no sequence more than without


@pytest.mark.parametrize("copies", [1, 3])
def test_schedule_moves_texts_once(spark, monkeypatch, copies):
    rows = [(i // copies, f"text {i}", "hot" if i % 9 < 7 else "cold") for i in range(900)] + [(None, "n", "hot"), (5, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    written, cut = [], mixing.cut
    monkeypatch.setattr(mixing, "cut", lambda df, name="cut": written.append(df.schema) or cut(df, name))
    got = mixing.scheduled(table)
    assert written and not any("text" in schema.simpleString() for schema in written)
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(rows)
    want = Counter((r["slot"], r["place"], r["source"]) for r in mixing.mix(table).collect())
    assert Counter((r["mix_slot"], r["mix_place"], r["source"]) for r in got.collect()) == want


def test_mixture_keeps_selected_rows_of_a_repeated_doc_id(spark):
    rows = [(7, "a")] * 300 + [(i, "b") for i in range(100, 200)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    selected = Counter((r["doc_id"], r["source"]) for r in mixing.mix(table, targets).collect() if r["selected"])
    assert 0 < selected[7, "a"] < 300
    assert Counter(map(tuple, mixing.mixture(table, targets).collect())) == selected


def test_schedule_keeps_exact_uneven_weights():
    for weights, slots in (([1 / 3, 1 / 3, 1 / 3], 3000), ([0.0001, 1 / 3, 0.5], 40_000), ([0.4, *[0.6 / k for k in range(1, 1500)]], 20_000)):
        ks, seen = mixing.whole_weights(weights), [0] * len(weights)
        whole = sum(ks)
        for t, (i, j) in enumerate(mixing.schedule(ks, slots), 1):
            assert j == seen[i]
            seen[i] += 1
            assert abs(seen[i] * whole - ks[i] * t) < whole  # less than one block off, as it gets a slot
            if t % 1000 == 0:
                assert all(abs(n * whole - k * t) < whole for n, k in zip(seen, ks))


def test_mixing_follows_many_uneven_sources(spark):
    rows = [(i, f"s{s}") for s in range(1200) for i in range(1 + 40 * (s == 3) + s % 3)]
    table = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(table, block_rows=1, frame_slots=500).collect()
    size, seen = Counter(s for _, s in rows), Counter()
    assert sorted(r["slot"] for r in got) == list(range(len(rows)))
    for n, r in enumerate(sorted(got, key=lambda r: r["slot"]), 1):
        seen[r["source"]] += 1
        assert n % 50 or all(abs(seen[s] * len(rows) - k * n) < len(rows) for s, k in size.items())


def test_pii_terms_of_rare_entities_far_away(spark):
    common = " ".join(["every text says these plain words again"] * 60)
    rows = [(0, f"Quillfeather {common} ann@x.example and {common} quillfeather"), (1, f"10.1.2.3 {common} Ostrander")]
    rows += [(2, f"Ostrander {common} 10.1.2.3"), (3, "vexley@y.example")] + [(10 + i, f"{common} and more") for i in range(60)]
    rows += [(100, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(table).collect()}
    assert out[0] == f"* {common} [EMAIL] and {common} *" and out[3] == "[EMAIL]"
    assert out[1] == f"[IP] {common} *" and out[2] == f"* {common} [IP]" and out[10] == rows[4][1]


def test_language_models_every_label(spark):
    r, rows = random.Random(8), []
    for k in range(70):  # the later labels are the rarer ones, each in letters of its own
        letters = [chr(0x4E00 + 40 * k + i) for i in range(12)]
        words = ["".join(r.choice(letters) for _ in range(4)) for _ in range(8)]
        rows += [(100 * k + i, " ".join(r.choice(words) for _ in range(60)), f"l{k:02}", "h.example") for i in range(3 if k < 64 else 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = {i: l for i, _, l, _ in rows}
    results = []
    for most in (langid.BLOCK_LANGUAGES, 9, 1000):
        got = langid.identify(langid.evidence(table), langid.fit(table, most=most)).collect()
        assert {g["doc_id"]: g["lang"] for g in got} == want and all(g["kept"] for g in got)
        results.append(sorted((g["doc_id"], round(g["confidence"], 9)) for g in got))
    assert results[0] == results[1] == results[2]
    assert langid.known_language(table).count() == len(rows)
