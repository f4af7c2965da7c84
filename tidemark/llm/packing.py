"""Best-fit packing (3): sum-of-squares packing of documents into sequences.

The rule: an item goes where the sum of the squared counts of open bins per residual
gap becomes smallest.  Only sizes matter to it, so it runs on the histogram of
piece lengths (at most ``capacity`` rows, whatever the input): items of one size are
packed ``m`` at a time into ``m`` equal bins, ``m`` a power of eight chosen so that
about ``STEPS`` placements are made; what does not fill an ``m`` goes on with ``m / 8``,
down to single items.  Bins that stay open are then dissolved and their items placed
again by the same rule, a new bin only when none fits.  That measured 0.1 % above the
bound total / capacity.

Every piece finds its place by its position among the pieces of its length
(``keyed_ordinal``) and one join to the table of places, so no document passes through
the driver.  Only pieces longer than ``capacity`` are cut, the first piece taking the
remainder.

Cases: null and empty texts are documents of the end id alone; repeated rows are
packed once each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, keyed_ordinal, read_table, releasing
from tidemark.llm.tokens import SPACED_PARTS, Encoder
from tidemark.plans.ordinal import with_ordinal

CAPACITY = 1024
END_ID = 2
#: Placements that the packing of one multiplicity makes, about.
STEPS = 200_000
BYTE_BPE = "byte_bpe_50k.json"
#: Words of one generation of the encoder's cache, few as packing follows larger stages in the pipeline.
CACHE_WORDS = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, cache_words: int = CACHE_WORDS,
           order: Sequence[str] = ()) -> DataFrame:
    """Tokenised documents cut into pieces of at most ``capacity`` ids: PIECES, then the document's ``order`` columns (long)."""
    order = list(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path, " ", cache_words, spaced=SPACED_PARTS), np.array([end_id], "<u4").tobytes()
        names = ("doc_id", "piece", "start", "length", "ids_crc32", *order)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.int64()] * len(order))
        for batch in batches:
            texts = (t or "" for t in batch.column(1).to_pylist())
            out: list[tuple] = []
            carried = zip(*(batch.column(2 + i).to_pylist() for i in range(len(order)))) if order else itertools.repeat(())
            for doc_id, own, ids in zip(batch.column(0).to_pylist(), carried, encoder.ids(texts)):
                ids += end
                n = len(ids) // 4
                at, to, k = 0, n % capacity or min(n, capacity), 0
                while at < n:
                    out.append((doc_id, k, at, to - at, zlib.crc32(memoryview(ids)[4 * at : 4 * to]), *own))
                    at, to, k = to, to + capacity, k + 1
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).cast("long").alias(c) for c in order])
    return rows.mapInArrow(releasing(run), PIECES + "".join(f", {c} long" for c in order))


def _place(sizes: np.ndarray, capacity: int, new_bins: bool) -> list[list[int]]:
    """Sum-of-squares packing of ``sizes`` in the order given; bins as lists of item numbers.

    ``new_bins``: a new bin competes with the open ones; else it is opened only
    when no open bin has room.
    """
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    never = np.iinfo(np.int64).max
    for item, size in enumerate(sizes.tolist()):
        # the sum's change for each gap g = size..capacity (capacity: a new bin)
        change = 2 * count[: capacity - size + 1] + 1
        change[0] = 0  # a full bin counts no more
        grown = change + (1 - 2 * count[size:])
        empty = count[size:] == 0
        grown[empty] = never
        if new_bins or empty[:-1].all():
            grown[-1] = change[-1]
        left = int(grown.argmin())
        gap = left + size
        if gap == capacity:
            b = len(bins)
            bins.append([])
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[b].append(item)
        if left:
            open_bins[left].append(b)
            count[left] += 1
    return bins


def place_sizes(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers) for ``sizes``: one pass, then the open bins again."""
    order = np.argsort(-sizes, kind="stable")
    done, again = [], []
    for b in _place(sizes[order], capacity, True):
        items = order[b].tolist()
        if sizes[items].sum() == capacity:
            done.append(items)
        else:
            again += items
    rest = np.array(again, dtype=np.int64)
    rest = rest[np.argsort(-sizes[rest], kind="stable")]
    return done + [rest[b].tolist() for b in _place(sizes[rest], capacity, False)]


def multiplicities(n: int, steps: int = STEPS) -> list[int]:
    """Descending powers of eight, the first so large that ``n`` items are about ``steps`` placements."""
    m = 1
    while n > steps * m:
        m *= 8
    out = [m]
    while m > 1:
        m //= 8
        out.append(m)
    return out


def places(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[dict[str, np.ndarray], list[int], int]:
    """Places of every item: (size, chunk) -> first sequence, offset; multiplicities; sequences.

    The ``k``-th item of a size belongs to a chunk of ``m`` items; item ``i`` of the chunk
    goes to sequence ``first + i``.
    """
    levels = multiplicities(sum(histogram.values()), steps)
    left, next_chunk, sequences = dict(histogram), dict.fromkeys(histogram, 0), 0
    out: dict[str, list] = {"size": [], "chunk": [], "first": [], "offset": []}
    for m in levels:
        sizes, chunks = [], []
        for size in sorted(left, reverse=True):
            whole, left[size] = divmod(left[size], m)
            sizes += [size] * whole
            chunks += range(next_chunk[size], next_chunk[size] + whole)
            next_chunk[size] += whole
        at = np.array(sizes, dtype=np.int64)
        for items in place_sizes(at, capacity):
            offset = 0
            for i in items:
                out["size"].append(sizes[i])
                out["chunk"].append(chunks[i])
                out["first"].append(sequences)
                out["offset"].append(offset)
                offset += sizes[i]
            sequences += m
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}, levels, sequences


def pack(items: DataFrame, capacity: int = CAPACITY, steps: int = STEPS, order: Sequence[str] = ()) -> DataFrame:
    """``items`` (PIECES, written) with ``sequence_id`` and ``offset``, then the ``order`` columns.

    With ``order``, sequences are numbered by the first of their pieces in that order.
    """
    spark = items.sparkSession
    sizes = items.groupBy("length").count().collect()  # at most ``capacity`` rows
    short = {r["length"]: r["count"] for r in sizes if r["length"] < capacity}
    table, levels, sequences = places(short, capacity, steps)
    ranked = keyed_ordinal(items, "length", ["doc_id", "piece", "start"], "rank")
    # chunk and place in it of the rank-th item of its length
    counts = spark.createDataFrame([(k, v) for k, v in short.items()], "size long, n long")
    rest, n, chunk, inside = F.col("rank"), F.col("n"), F.lit(0), F.lit(0)
    steps_taken = []
    for m in levels:
        whole = F.floor(n / m)
        steps_taken.append((rest < whole * m, chunk + F.floor(rest / m), F.pmod(rest, F.lit(m))))
        rest, n, chunk = rest - whole * m, n - whole * m, chunk + whole
    which = F.lit(None).cast("long")
    inside = F.lit(None).cast("long")
    for hit, c, i in reversed(steps_taken):
        which, inside = F.when(hit, c).otherwise(which), F.when(hit, i).otherwise(inside)
    place = spark.createDataFrame(pa.table({k: pa.array(v) for k, v in table.items()}))
    place = place.select(F.col("size").alias("p_size"), F.col("chunk").alias("p_chunk"), "first", "offset")
    own = ranked.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.col("rank") + F.lit(sequences), "offset": F.lit(0).cast("long")}
    )
    shared = (
        ranked.filter(F.col("length") < capacity)
        .join(F.broadcast(counts), F.col("length") == F.col("size"))  # at most ``capacity`` rows
        .withColumns({"__chunk": which, "__inside": inside})
        .join(place, (F.col("length") == F.col("p_size")) & (F.col("__chunk") == F.col("p_chunk")))
        .withColumn("sequence_id", F.col("first") + F.col("__inside"))
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *order]
    packed = shared.select(columns).unionByName(own.select(columns))
    return in_order(packed, order) if order else packed


def in_order(packed: DataFrame, order: Sequence[str]) -> DataFrame:
    """``packed`` with its sequences numbered from 0 by the first of their pieces in ``order``."""
    packed = cut(packed, "packed")
    firsts = packed.groupBy(F.col("sequence_id").alias("__s")).agg(F.min(F.struct(*order)).alias("__first"))
    firsts = firsts.select("__s", *[F.col("__first")[c].alias(f"__{c}") for c in order])
    numbered = with_ordinal(firsts, [*[f"__{c}" for c in order], "__s"], "__number").select("__s", "__number")
    moved = packed.join(numbered, F.col("sequence_id") == F.col("__s"))
    return moved.withColumn("sequence_id", F.col("__number")).select(packed.columns)


def op3_packing(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, cache_words: int = CACHE_WORDS,
                order: Sequence[str] = ()) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents") if docs is None else docs
    return pack(cut(pieces(docs, tokenizer_path(BYTE_BPE), cache_words=cache_words, order=order), "pieces"), order=order)
