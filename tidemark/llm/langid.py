"""Language ID (10): Bayesian evidence fusion.

    P(language | all) ~ P(text | language)^TEMPER * P(declared | language) * P(language | host)

* Text: byte trigrams (ASCII letters lower-cased, other ASCII a space), hashed into
  ``BINS`` bins per language.  The bins are fitted on all labelled rows, of every label,
  by grouped counts, and used in blocks of ``BLOCK_LANGUAGES`` languages; a class "und" has the bytes of all languages
  but no order.  Every text is counted and scored whole.
* Declared language (markup or metadata): how often a text of each language carries
  each declaration, counted over all rows, smoothed.
* Host and address suffix: hierarchically smoothed priors, host to suffix to all,
  from grouped counts of the text decisions: (n(l, host) + KAPPA p(l | suffix)) /
  (n(host) + KAPPA).

Only "und" is rejected: no known language explains the document better than unordered
bytes do.  Cases: null or empty texts are decided by the other evidence; null or
unknown declarations and null hosts are values of their own; without any labelled row
nothing is rejected and lang is null; ties go to the alphabetically first language;
rows that repeat a doc_id are decided each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table, releasing
from tidemark.llm.textbytes import columns, groups, mix

BINS = 1 << 16
#: Languages that a task or the driver holds at once: a table of BLOCK_LANGUAGES * BINS numbers.
BLOCK_LANGUAGES = 64
#: Overlapping trigrams repeat evidence; a third of their log likelihood counts.
TEMPER = 1 / 3
KAPPA = 20.0
#: Share of unordered bytes in every language: names, numbers and codes do not refute a language.
UNORDERED = 0.3
UND = "und"


def _alphabet() -> np.ndarray:
    table = np.arange(256, dtype=np.uint64)
    table[:128] = 32
    for c in range(97, 123):
        table[c] = table[c - 32] = c
    return table


def trigram_bins(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of the trigram at each byte (``BINS`` where none starts) and the mapped bytes."""
    b = table[data]
    bins = np.full(len(b), BINS, np.int64)
    if len(b) > 2:
        tri = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
        bins[:-2] = (mix(tri) >> np.uint64(48)).astype(np.int64)
        ends = offsets[1:][np.diff(offsets) > 0] - offsets[0]
        bins[ends - 1] = BINS
        bins[ends[ends > 1] - 2] = BINS
    return bins, b


def bin_counts(labelled: DataFrame, langs: list[str], most: int) -> DataFrame:
    """``(lang, bin, n)`` of all ``labelled`` (l, t) texts, whole; as language ``len(langs)``, the bytes.

    A task holds ``most`` languages and passes their counts on when others come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, width = _alphabet(), BINS + 1
        counts, single = np.zeros(min(len(langs), most) * width, np.int64), np.zeros(256, np.int64)
        place, held = np.full(len(langs), -1, np.int64), []

        def found(l: np.ndarray, k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            arrays = [pa.array(l.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(n)]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "bin", "n"])

        def trigrams() -> pa.RecordBatch:
            n = counts.reshape(-1, width)[:, :BINS]
            l, k = np.nonzero(n)
            return found(np.array(held, np.int64)[l], k, n[l, k])

        for batch in batches:
            data, offsets = columns(batch, "t")
            lang = pc.index_in(batch.column(0), value_set=pa.array(langs, batch.column(0).type)).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in groups(offsets):
                bins, b = trigram_bins(data[offsets[i] : offsets[j]], offsets[i : j + 1], table)
                of_byte = np.repeat(lang[i:j], np.diff(offsets[i : j + 1]))
                single += np.bincount(b.astype(np.int64), minlength=256)
                present = np.unique(lang[i:j])
                for first in range(0, len(present), most):
                    some = present[first : first + most]
                    new = some[place[some] < 0]
                    if len(held) + len(new) > most:
                        yield trigrams()
                        counts[:], place[:], held, new = 0, -1, [], some
                    place[new] = len(held) + np.arange(len(new))
                    held.extend(new.tolist())
                    if len(some) == len(present):
                        at = place[of_byte] * width + bins
                    else:
                        own = np.isin(of_byte, some)
                        at = place[of_byte[own]] * width + bins[own]
                    counts += np.bincount(at, minlength=len(counts))
        yield trigrams()
        used = np.flatnonzero(single)
        yield found(np.full(len(used), len(langs)), used, single[used])

    return labelled.mapInArrow(releasing(run), "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", declared: str = "lang", most: int = BLOCK_LANGUAGES) -> tuple[list[str], list[Broadcast]]:
    """Languages and, in blocks of ``most``, the log probability of each bin in each of them, "und" last."""
    labelled = docs.select(F.col(declared).alias("l"), F.col(text).alias("t")).filter("l IS NOT NULL AND t IS NOT NULL")
    langs = sorted(r["l"] for r in labelled.select("l").distinct().collect())  # one row per language
    if not langs:
        return [], []
    found = cut(bin_counts(labelled, langs, most), "bin-counts")
    table, single = _alphabet(), np.ones(256)
    for r in found.filter(F.col("lang") == len(langs)).collect():  # 256 rows at most
        single[r["bin"]] += r["n"]
    p = np.log(single / single.sum())
    used = np.unique(table).astype(np.int64)
    unordered = np.full(BINS, -np.inf)
    # probability of each bin when the bytes come in any order: summed over all trigrams of the alphabet
    for x in used.tolist():
        y = np.repeat(used, len(used)).astype(np.uint64)
        z = np.tile(used, len(used)).astype(np.uint64)
        tri = (np.uint64(x) << np.uint64(16)) | (y << np.uint64(8)) | z
        np.logaddexp.at(unordered, (mix(tri) >> np.uint64(48)).astype(np.int64), p[x] + p[y.astype(int)] + p[z.astype(int)])
    unordered = np.logaddexp(unordered, math.log(1e-9 / BINS))
    blocks = []
    for first in range(0, len(langs), most):
        size = min(most, len(langs) - first)
        part = found.filter(F.col("lang").between(first, first + size - 1)).toPandas()  # most * BINS rows at most
        counts = np.zeros((size, BINS))
        counts[part["lang"] - first, part["bin"]] = part["n"]
        shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        logs = np.log((1 - UNORDERED) * shares + UNORDERED * np.exp(unordered))
        if first + size == len(langs):
            logs = np.vstack([logs, unordered])
        blocks.append(docs.sparkSession.sparkContext.broadcast(np.hstack([logs, np.zeros((len(logs), 1))])))
    return langs, blocks


def text_scores(rows: DataFrame, n: int, blocks: list[Broadcast]) -> DataFrame:
    """``rows`` (doc_id, host, declared, text) with the ``n`` log likelihoods of the whole text instead of it; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _alphabet()
        for batch in batches:
            data, offsets = columns(batch, "text")
            sums, first = np.zeros((batch.num_rows, n)), 0
            for block in blocks:
                logs = block.value
                for i, j in groups(offsets):
                    bins, _ = trigram_bins(data[offsets[i] : offsets[j]], offsets[i : j + 1], table)
                    rel = offsets[i : j + 1] - offsets[i]
                    for k, row in enumerate(logs, first):
                        total = np.concatenate([[0.0], np.cumsum(row[bins])])
                        sums[i:j, k] = total[rel[1:]] - total[rel[:-1]]
                first += len(logs)
                if len(blocks) > 1 and block._path is not None:  # one block at a time; the next batch reads it again
                    del logs
                    block.__dict__.pop("_value", None)
            for i in range(0, batch.num_rows, 1000):
                part, own = batch.slice(i, 1000), sums[i : i + 1000]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * n, pa.int32()), pa.array(own.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), lists], ["doc_id", "host", "declared", "ll"])

    return cut(rows.mapInArrow(releasing(run), "doc_id long, host string, declared string, ll array<double>"), "text-scores")


def suffix(host: Column) -> Column:
    """Address suffix: what follows the last dot of the host; empty where there is none."""
    return F.when(host.contains("."), F.lower(F.substring_index(host, ".", -1))).otherwise("")


def identify(rows: DataFrame, model: tuple[list[str], list[Broadcast]]) -> DataFrame:
    """``rows`` (doc_id, host, declared, text) to (doc_id, lang, confidence, kept)."""
    langs, blocks = model
    if not langs:
        none = F.lit(None).cast("string").alias("lang")
        return rows.select("doc_id", none, F.lit(0.0).alias("confidence"), F.lit(True).alias("kept"))
    n, names = len(langs) + 1, [*langs, UND]
    best = F.array_position("ll", F.array_max("ll")) - 1
    scored = text_scores(rows, n, blocks).withColumn("best", best.cast("int"))
    labels = rows.sparkSession.createDataFrame(list(zip(langs, range(n))), "label string, label_k int")
    scored = scored.join(labels, F.col("declared") == F.col("label"), "left")
    index = F.when(F.col("declared").isNull(), n).otherwise(F.coalesce("label_k", F.lit(n - 1)))
    scored = scored.withColumns({"declared_as": index, "suffix": suffix(F.col("host"))})

    def tallies(counts: DataFrame, *by: str) -> DataFrame:
        """``by``, the counts c of the n languages and their sum m."""
        entry = F.map_from_entries(F.collect_list(F.struct("best", "c")))
        grouped = counts.groupBy(*by, "best").agg(F.sum("c").alias("c")).groupBy(*by).agg(entry.alias("found"), F.sum("c").alias("m"))
        return grouped.select(*by, "m", F.expr(f"transform(sequence(0, {n - 1}), k -> coalesce(try_element_at(found, k), 0L))").alias("c"))

    literals = lambda values: F.array(*map(F.lit, values))
    smooth = F.expr(f"transform(c, (x, k) -> (x + {KAPPA}D * up[k]) / (m + {KAPPA}D))")
    hosts = cut(scored.groupBy("host", "suffix", "best").agg(F.count("*").alias("c")), "host-counts")
    every = {r["best"]: r["c"] for r in hosts.groupBy("best").agg(F.sum("c").alias("c")).collect()}  # n rows at most
    total = sum(every.values())
    overall = [(every.get(k, 0) + 1.0) / (total + n) for k in range(n)]
    suffixes = tallies(hosts, "suffix").withColumn("up", literals(overall)).select(F.col("suffix").alias("of"), smooth.alias("up"))
    priors = tallies(hosts, "host", "suffix").join(suffixes, F.col("suffix").eqNullSafe(F.col("of")))
    priors = cut(priors.select(F.col("host").alias("p_host"), smooth.alias("prior")), "host-priors")

    room = literals([every.get(k, 0) + 0.5 * (n + 1) for k in range(n)])
    said = tallies(scored.groupBy("declared_as", "best").agg(F.count("*").alias("c")), "declared_as").withColumn("room", room)
    said = said.select(F.col("declared_as").alias("s_as"), F.expr("transform(c, (x, k) -> ln((x + 0.5D) / room[k]))").alias("said"))
    said = cut(said, "declared-counts")  # n + 1 rows at most
    fused = F.expr("transform(ll, (x, k) -> x * temper + ln(prior[k]) + said[k])")
    posterior = F.expr("1.0 / aggregate(score, 0.0D, (a, x) -> a + exp(x - array_max(score)))")
    decided = (
        scored.join(priors, F.col("host").eqNullSafe(F.col("p_host")))
        .join(said, F.col("declared_as") == F.col("s_as"))
        .withColumn("temper", F.lit(TEMPER))
        .withColumn("score", fused)
    )
    name = F.element_at(F.array(*map(F.lit, names)), F.array_position("score", F.array_max("score")).cast("int"))
    return decided.select("doc_id", name.alias("lang"), posterior.alias("confidence"), (name != UND).alias("kept"))


def evidence(docs: DataFrame) -> DataFrame:
    """The evidence that ``documents`` carries: its lang is the declaration, its source the host."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("host"), F.col("lang").alias("declared"), "text"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(evidence(docs), fit(docs))


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that language ID rejects (a null doc_id stays).

    Rows are judged one by one, known by a hash of all that was judged, so
    another text of a rejected row's doc_id stays.
    """
    row = F.xxhash64("doc_id", F.lit("|"), "source", F.lit("|"), "lang", F.lit("|"), "text")
    judged = evidence(docs.withColumn("doc_id", F.when(F.col("doc_id").isNotNull(), row)))
    verdict = identify(judged, fit(docs)).filter(~F.col("kept") & F.col("doc_id").isNotNull())
    gone = cut(verdict.select(F.col("doc_id").alias("__gone")).distinct(), "no-language")
    return docs.join(gone, F.when(docs["doc_id"].isNotNull(), row) == F.col("__gone"), "left_anti")
