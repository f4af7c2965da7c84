"""MinHash near-dedup (2) with SetSketch registers.

1. One pass over the texts: the 64-bit hashes of each document's distinct word
   shingles give the set size, a 128-bit fingerprint of the set, and ``m`` SetSketch
   registers: register i is ``floor(1 - log_base(h_i))`` of the smallest exponential
   variable h_i of the set's shingles, truncated to 0..255.  Registers of two sets
   merge by maximum and agree with a probability that follows the Jaccard similarity.
2. Documents with one fingerprint are one class, represented by the smallest doc_id.
3. Registers are read in bands of ``ROWS``; the number of bands follows from the
   similarity so that a pair at the threshold shares no band with a probability of at
   most ``MISS``.  The hub of a bucket is its class with the most company over all its
   buckets, so the centre of a group of near copies where one exists.
4. Pairs are estimated jointly by likelihood from the counts of registers that are
   larger, smaller and equal and from both set sizes.  A pair is dropped only when the
   threshold and everything above it is less likely than the best estimate by
   a factor of exp(``EVIDENCE``).  The others are verified on the full sets, which are
   computed once for the classes that share a bucket with another.
5. Each class is paired with its best hub, links give components; then with its other
   hubs, where these are in another component.
6. Buckets that still hold several components are settled exactly, by prefix filtering
   over the full sets of their classes.  So every pair that shares a bucket is linked through
   its component or has been excluded or tested, without all pairs of a group.

Cases: null, empty or white-space texts have an empty set, are linked with nothing and
are kept; fewer words than a shingle are one shingle of all words; rows that repeat a
doc_id with one text are one document each, and kept together; other texts of a doc_id are
documents of their own, linked and dropped apart from the first; a null doc_id
takes no part in linking and comes back with a null component and kept = true; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table, releasing, split_by_ids
from tidemark.llm.components import components
from tidemark.llm.textbytes import Hasher, columns, mix, random_odd, segment_sum, word_groups
from tidemark.plans.ordinal import with_ordinal

WORDS = 5
ROWS = 6
MISS = 1e-6
EVIDENCE = 14.0
#: Bits of the bitmap of candidate ids.
FILTER_BITS = 1 << 24
#: SetSketch: base of the spacing, rate of the exponential variables, largest register.
BASE, RATE, TOP = 1.1, 20.0, 255

SKETCHES = "doc_id long, n_shingles long, f1 long, f2 long, registers binary"


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log(1 - similarity**rows)))


def shingle_groups(batch: pa.RecordBatch, hasher: Hasher, words: int = WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For row ranges [i, j): sorted distinct shingle hashes of each row and their offsets."""
    data, offsets = columns(batch, "text")
    by_place = random_odd(words, 1)
    for i, j, h, at in word_groups(hasher, data, offsets):
        n = np.diff(at)
        full = np.zeros(0, np.uint64)
        if len(h) >= words:
            span = len(h) - words + 1
            full = h[:span] * by_place[0]
            for k in range(1, words):
                full += h[k : k + span] * by_place[k]
            full = mix(full)
        parts = []
        for k, size in enumerate(n.tolist()):
            lo = int(at[k])
            if size >= words:
                parts.append(np.unique(full[lo : lo + size - words + 1]))
            elif size:
                parts.append(mix((h[lo : lo + size] * by_place[:size]).sum(keepdims=True) + np.uint64(size)))
            else:
                parts.append(np.empty(0, np.uint64))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        yield i, j, np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def registers_of(shingles: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """SetSketch registers, one row per set; zeros for an empty set."""
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), m), np.uint8)
    some = np.flatnonzero(sizes)
    if len(some) == 0:
        return out
    starts = offsets[some]
    low = np.empty((len(some), m), np.float64)
    for i, a in enumerate(random_odd(m, 2)):
        low[:, i] = np.minimum.reduceat(shingles * a, starts)
    # the smallest of uniform variables gives the smallest of exponential ones
    h = -np.log1p(-(low + 0.5) / 2.0**64) / RATE
    out[some] = np.clip(np.floor(1 - np.log(h) / math.log(BASE)), 0, TOP)
    return out


def sketches(docs: DataFrame, m: int, words: int = WORDS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids = batch.column(0)
            for i, j, shingles, offsets in shingle_groups(batch, hasher, words):
                n = np.diff(offsets)
                f1 = segment_sum(mix(shingles), offsets)
                f2 = segment_sum(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), offsets)
                regs = registers_of(shingles, offsets, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(n.astype(np.int64)),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.array([r.tobytes() for r in regs], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "f1", "f2", "registers"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), SKETCHES)


def likely(more: np.ndarray, less: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float) -> np.ndarray:
    """Whether a Jaccard similarity of at least ``similarity`` is not excluded by the registers.

    Joint likelihood of the counts of registers that are larger in a, smaller and equal,
    over a grid of similarities that the set sizes allow.
    """
    u = na / (na + nb)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)
    best, above = np.full(len(na), -np.inf), np.full(len(na), -np.inf)
    grid = np.append(np.linspace(0, 1, 61), similarity)
    for g in grid:
        j = np.minimum(g, most)
        a = np.clip(p(np.clip(u - v * j, 0, 1)), 1e-12, 1)
        b = np.clip(p(np.clip(v - u * j, 0, 1)), 1e-12, 1)
        value = more * np.log(a) + less * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1))
        best = np.maximum(best, value)
        if g >= similarity:
            above = np.maximum(above, value)
    return (best - above < EVIDENCE) & (most >= similarity - 1e-12)


def plausible(pairs: DataFrame, reps: DataFrame, similarity: float) -> DataFrame:
    """Those ``pairs`` (a, b) that the registers of ``reps`` do not exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ra, rb = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (4, 5)
            )
            na, nb = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (2, 3))
            more, less = (ra > rb).sum(1), (ra < rb).sum(1)
            keep = likely(more, less, ra.shape[1] - more - less, na, nb, similarity)
            yield batch.select([0, 1]).filter(pa.array(keep))

    one = reps.select(F.col("rep").alias("ra"), F.col("n_shingles").alias("na"), F.col("registers").alias("ga"))
    two = reps.select(F.col("rep").alias("rb"), F.col("n_shingles").alias("nb"), F.col("registers").alias("gb"))
    wide = pairs.join(one, F.col("a") == F.col("ra")).join(two, F.col("b") == F.col("rb"))
    wide = wide.filter(
        (F.col("na") >= F.col("nb") * similarity - 1e-6) & (F.col("nb") >= F.col("na") * similarity - 1e-6)
    )
    return wide.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(releasing(run), "a long, b long")


def id_bits(nodes: DataFrame, position: Column) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits, set at the position of each node: 2 MB, however many nodes."""
    at = position + 1
    rows = (
        nodes.groupBy(F.bitmap_bucket_number(at).alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in rows:
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def shingle_sets(docs: DataFrame, nodes: DataFrame, words: int = WORDS) -> DataFrame:
    """``(id, shingles)`` of the documents in ``nodes`` (node; written), written.

    A bitmap of the nodes' hashed ids keeps nearly all other texts from being read
    twice; the few more that pass it are harmless, and beyond ``FILTER_BITS`` / 8 nodes a
    join removes them.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bits = docs.sparkSession.sparkContext.broadcast(id_bits(nodes, place(F.col("node"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            if batch.num_rows == 0:
                continue
            ids = batch.column(0)
            for i, j, shingles, offsets in shingle_groups(batch, hasher, words):
                values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), values], ["id", "shingles"])

    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    sets = known.withColumn("place", place(F.col("doc_id"))).mapInArrow(releasing(run), "id long, shingles array<long>")
    if nodes.count() > FILTER_BITS // 8:
        sets = sets.join(nodes, F.col("id") == F.col("node"), "left_semi")
    return cut(sets, "shingle-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs`` (a, b) whose full sets reach the similarity: (a, b), written."""
    sa = sets.select(F.col("id").alias("ia"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("id").alias("ib"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return cut(
        pairs.join(sb, F.col("b") == F.col("ib"))
        .join(sa, F.col("a") == F.col("ia"))
        .filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
        .select("a", "b"),
        "links",
    )


def prefix_pairs(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among ``classes`` (rep, own) that may reach the similarity.

    Exact prefix filtering: two sets of sizes x and y at the threshold share at least
    need = percent / (100 + percent) * (x + y) shingles, so with the shingles of each set
    ordered by rarity they share one among the first x - need + 1 and y - need + 1.  Near
    copies below the threshold differ in their rarest shingles and do not meet.
    """
    rows = classes.join(sets, F.col("rep") == F.col("id")).select(
        "rep", "own", F.size("shingles").alias("n"), F.explode("shingles").alias("s")
    )
    rows = cut(rows, "unsettled-shingles")
    spread = rows.groupBy(F.col("s").alias("t")).agg(
        F.count("*").alias("df"), F.min("own").alias("lo"), F.max("own").alias("hi")
    )
    spread = cut(spread, "shingle-spread")
    order = Window.partitionBy("rep").orderBy("df", "s")
    ranked = rows.join(spread, F.col("s") == F.col("t")).withColumn("pos", F.row_number().over(order))
    # positions from 1; the longest prefix is that towards a smallest partner
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-6) + 1
    first = ranked.filter((F.col("pos") <= longest) & (F.col("lo") != F.col("hi")))
    first = cut(first.select("s", "rep", "own", "n", "pos"), "prefixes")
    x, y = first.toDF("s", "a", "oa", "na", "pa"), first.toDF("sb", "b", "ob", "nb", "pb")
    need = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent) - 1e-6)
    return x.join(
        y,
        (F.col("s") == F.col("sb"))
        & (F.col("a") > F.col("b"))
        & (F.col("oa") != F.col("ob"))
        & (F.col("pa") <= F.col("na") - need + 1)
        & (F.col("pb") <= F.col("nb") - need + 1)
        & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")),
    ).select("a", "b").distinct()


def with_own_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``__own_id``, one number per doc_id and text, and the doc_ids of the new numbers.

    A doc_id's first text (by hash) keeps the doc_id; further texts get numbers above all doc_ids,
    so the smallest number of a group is a doc_id wherever one of its texts is a first one.  Mostly
    no doc_id has two texts: then nothing is joined and the second value is None.
    """
    keyed = docs.withColumn("__own_id", F.col("doc_id").cast("long"))
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.select(F.col("doc_id").cast("long").alias("of"), th.alias("th")).filter("of IS NOT NULL")
    firsts = texts.groupBy("of").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).filter("lo <> hi")
    firsts = cut(firsts.select("of", "lo"), "repeated-ids")
    if firsts.isEmpty():
        return keyed, None
    more = texts.join(firsts, "of").filter("th <> lo").select("of", "th").distinct()
    top = texts.agg(F.max("of").alias("top")).first()["top"]
    more = cut(with_ordinal(cut(more, "further-texts"), ["of", "th"], "at"), "further-texts")
    more = cut(more.select("of", "th", (F.col("at") + F.lit(top + 1)).cast("long").alias("new_id")), "own-ids")
    joined = keyed.join(
        more.select(F.col("of").alias("__of"), F.col("th").alias("__th"), F.col("new_id").alias("__new")),
        (F.col("__own_id") == F.col("__of")) & (th == F.col("__th")),
        "left",
    )
    keyed = joined.withColumn("__own_id", F.coalesce("__new", "__own_id")).drop("__of", "__th", "__new")
    return keyed, more.select("new_id", "of")


def near_duplicates(docs: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked at a Jaccard similarity of ``percent`` / 100 of their sets of
    ``words``-word shingles.  Different texts of one doc_id are documents of their own; a
    component of such texts alone is named by the doc_id of one of them.
    """
    keyed, new_ids = with_own_ids(docs)
    found = components_of(keyed.select(F.col("__own_id").alias("doc_id"), "text"), percent, words)
    if new_ids is None:
        return found
    named = new_ids.select(F.col("new_id").alias("__new"), F.col("of").alias("__of"))
    for c in ("doc_id", "component_id"):
        found = found.join(named, F.col(c) == F.col("__new"), "left").withColumn(c, F.coalesce("__of", c)).drop("__new", "__of")
    return found


def components_of(docs: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """``near_duplicates`` of documents whose doc_id stands for one text."""
    similarity = percent / 100
    bands = bands_for(similarity)
    sketch = cut(sketches(docs, bands * ROWS, words), "sketches")
    known = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(
        known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")).withColumnsRenamed(
            {"f1": "c1", "f2": "c2", "n_shingles": "cn"}
        ),
        "classes",
    )
    reps = known.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi")
    reps = cut(reps.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "n_shingles", "registers"), "reps")

    # one row per class and band; only buckets of two classes or more matter
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("registers"), k * ROWS + 1, F.lit(ROWS))),
    )
    rows = reps.select("rep", F.explode(keys).alias("bucket"))
    shared = cut(rows.groupBy(F.col("bucket").alias("key")).agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    found = cut(rows.join(shared, F.col("bucket") == F.col("key")).select("bucket", "n", "rep"), "members")
    company = cut(found.groupBy(F.col("rep").alias("node")).agg(F.sum("n").alias("weight")), "company")
    sets = shingle_sets(docs, company.select("node"), words)
    found = found.join(company, F.col("rep") == F.col("node")).select("bucket", "n", "rep", "weight")
    found = cut(found, "members")
    hubs = cut(
        found.groupBy(F.col("bucket").alias("key")).agg(F.max(F.struct("weight", -F.col("rep"))).alias("top")), "hubs"
    )
    members = cut(
        found.join(hubs, F.col("bucket") == F.col("key")).select(
            "bucket", "n", "rep", F.col("top.weight").alias("hub_weight"), (-F.col("top.col2")).alias("hub")
        ),
        "members",
    )

    stars = members.filter("rep <> hub")
    best = stars.groupBy(F.col("rep").alias("a")).agg(F.max(F.struct("hub_weight", "hub")).alias("top"))
    best = best.select("a", F.col("top.hub").alias("b"))
    links = verified(cut(plausible(best, reps, similarity), "pairs"), sets, percent)
    labels = components(links)

    def component_of(df: DataFrame, node: str, out: str) -> DataFrame:
        names = labels.select(F.col("node").alias("__node"), "label")
        return df.join(names, F.col(node) == F.col("__node"), "left").withColumn(
            out, F.coalesce("label", node)
        ).drop("__node", "label")

    other = stars.select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct().join(best, ["a", "b"], "left_anti")
    apart = component_of(component_of(other, "a", "la"), "b", "lb").filter("la <> lb").select("a", "b")
    links = cut(links.union(verified(cut(plausible(apart, reps, similarity), "pairs"), sets, percent)), "links")
    labels = components(links)

    # classes of the buckets that hold several components
    placed = component_of(members.filter("n > 2").select("bucket", "rep"), "rep", "own")
    placed = cut(placed, "placed")
    mixed = (
        placed.groupBy(F.col("bucket").alias("m_bucket"))
        .agg(F.min("own").alias("lo"), F.max("own").alias("hi"))
        .filter("lo <> hi")
        .select("m_bucket")
    )
    unsettled = placed.join(mixed, F.col("bucket") == F.col("m_bucket"), "left_semi").select("rep", "own").distinct()
    unsettled = cut(unsettled, "unsettled")
    if not unsettled.isEmpty():
        cross = cut(plausible(prefix_pairs(unsettled, sets, percent), reps, similarity), "cross-pairs")
        if not cross.isEmpty():
            links = links.union(verified(cross, sets, percent))
            labels = components(cut(links, "links"))

    names = labels.select(F.col("node"), "label")
    by_class = cut(
        classes.join(names, F.col("rep") == F.col("node"), "left").select(
            "c1", "c2", "cn", F.coalesce("label", "rep").alias("class_label")
        ),
        "class-labels",
    )
    same = (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & (F.col("n_shingles") == F.col("cn"))
    component = F.when(F.col("n_shingles") > 0, F.col("class_label")).otherwise(F.col("doc_id"))
    return (
        sketch.select("doc_id", "n_shingles", "f1", "f2")
        .join(by_class, same & F.col("doc_id").isNotNull(), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component (the smallest doc_id)."""
    keyed, _ = with_own_ids(docs)
    found = components_of(keyed.select(F.col("__own_id").alias("doc_id"), "text"), percent)
    gone = cut(found.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    some, others = split_by_ids(keyed, "__own_id", gone)
    return others.unionByName(some.join(gone, F.col("__own_id") == F.col("__gone"), "left_anti")).drop("__own_id")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), 85)
