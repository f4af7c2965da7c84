"""Batch DataFrame operators named by the reference's batch skeleton."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token separators of the word flat map (blank, tab, newline, return).
WORD_SEPARATORS = r"[ \t\n\r]+"


def flat_map_words(df: DataFrame, text: str = "text", out: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of every whole text."""
    tokens = F.explode(F.split(F.col(text), WORD_SEPARATORS))
    return df.select(*keep, tokens.alias(out)).where(F.col(out) != "")


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Flat map then count per word: partial counts are combined map-side."""
    return flat_map_words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def cogroup_aggregate(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_aggs: Mapping[str, Column],
    right_aggs: Mapping[str, Column],
    key: str = "key",
) -> DataFrame:
    """Co-group two inputs by key (J2) without materialising the groups.

    Each side is reduced per key first (partial aggregation before the
    shuffle), then the two reduced sides meet in a full outer join, so a key
    present on one side only still appears, with empty aggregates for the other.
    """
    lg = left.groupBy(F.col(left_key).alias(key)).agg(*[c.alias(n) for n, c in left_aggs.items()])
    rg = right.groupBy(F.col(right_key).alias(key)).agg(*[c.alias(n) for n, c in right_aggs.items()])
    return lg.join(rg, key, "full_outer")


class _Side:
    """The rows of one side of the current key, read from the sorted stream as they are asked for."""

    def __init__(self, stream: _Tagged, side: int):
        self.stream, self.side, self.key = stream, side, stream.key

    def __iter__(self) -> Iterator[dict]:
        return self

    def __next__(self) -> dict:
        s = self.stream
        if s.done or s.key != self.key or s.side != self.side:
            raise StopIteration
        row = s.row
        s.advance()
        return row


class _Tagged:
    """Cursor over Arrow batches of ``key, side, l, r`` sorted by key and side; one batch is held."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("k", "key", "side", "l", "r"))))
        self.done = False
        self.advance()

    def advance(self) -> None:
        row = next(self.rows, None)
        if row is None:
            self.done, self.key = True, None
        else:
            self.key, self.named, self.side = row[0], row[1], row[2]
            self.row = row[4] if row[2] else row[3]


def cogroup_apply(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    fn: Callable[[object, Iterable[dict], Iterable[dict]], Iterable[tuple]],
    schema: str,
    batch_rows: int = 10_000,
) -> DataFrame:
    """Co-group two inputs by key with a user function.

    ``fn(key, lefts, rights)`` yields tuples of ``schema`` and is called once per key of either
    side, in no fixed order.  ``lefts`` and ``rights`` are iterators over rows (dicts), to be read
    once and in this order; what the function leaves is skipped.  Both sides are tagged, unioned,
    shuffled by key and sorted by (key, side), so a task holds one Arrow batch, however many rows
    a key has.  NULL keys are one key; null rows of the other side are never seen.
    """
    kind = left.schema[left_key].dataType
    if kind != right.schema[right_key].dataType:
        raise ValueError(f"keys differ in type: {kind} and {right.schema[right_key].dataType}")
    # keys are told apart by a never-null text, so NULL is a key and floats group as Spark does
    text = F.coalesce(F.concat(F.lit("k"), F.col("key").cast("string")), F.lit("n")).alias("k")
    empty = {"l": F.lit(None).cast(left.schema), "r": F.lit(None).cast(right.schema)}
    sides = []
    for side, (df, key) in enumerate(((left, left_key), (right, right_key))):
        rows = df.select(F.col(key).alias("key"), F.struct(*df.columns).alias("row"))
        both = empty | {"r" if side else "l": F.col("row")}
        sides.append(rows.select(text, "key", F.lit(side).alias("side"), *[c.alias(n) for n, c in both.items()]))
    tagged = sides[0].unionByName(sides[1]).repartition("k").sortWithinPartitions("k", "side")
    out = left.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted, rows = to_arrow_schema(out), []
        stream = _Tagged(batches)
        while not stream.done:
            key, lefts, rights = stream.key, _Side(stream, 0), _Side(stream, 1)
            for row in fn(stream.named, lefts, rights):
                rows.append(dict(zip(wanted.names, row)))
                if len(rows) >= batch_rows:
                    yield pa.RecordBatch.from_pylist(rows, wanted)
                    rows = []
            while not stream.done and stream.key == key:
                stream.advance()
        yield pa.RecordBatch.from_pylist(rows, wanted)

    return tagged.mapInArrow(run, out)
