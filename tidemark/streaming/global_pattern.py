"""Non-keyed sequence matching on a stream without a single task (C4).

A pattern over a whole stream has no key to spread by, so each micro-batch is treated as a
range of the event-time order and summarised.  Rows wait until the watermark passes them; those
that are ready lie behind all earlier ones.  Over the ready rows the bucketed scans of
``operators.sequence`` give, for each row, the next row of each step and its continuation:

* a start row that completes within the range is a match;
* one that does not is *open*, at the step that it waits for, and is written once;
* the range's summary is, for each step, the first row that satisfies it with its
  continuation ("first completion per stage"): one row, whatever the range holds.

All open starts of one batch that wait for the same step have the same future, so they are one
group.  A batch composes its summary with the table of groups (at most steps - 1 new rows a
batch), and only when a group completes are its starts read and joined.  Neither open starts
nor history are read or written again, and no step has one key or one task.

The state lies in folders per batch below ``out``; a batch that is run again overwrites its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.sequence import SequencePattern, drop_late
from tidemark.plans.lineage import cut
from tidemark.plans.ordinal import with_ordinal
from tidemark.plans.scan import lead_is_balanced, needs_buckets, order_stats, scan

GROUP = "born long, stage0 int"


class GlobalPattern:
    """``foreachBatch`` function; ``end`` flushes what waits, ``matches`` reads the results.

    ``order`` is a total order of the rows, event time first; ``payload`` what a match keeps of
    each row.  ``before`` is the watermark when a row arrived: rows at or behind it are late and
    dropped (C7).  ``after`` is the one after it: the largest seen so far says which rows are ready.
    """

    def __init__(self, out: str, pattern: SequencePattern, schema: StructType, order: Sequence[str],
                 payload: Sequence[str], before: str = "wm_ms", after: str = "after_ms"):
        if len(pattern.steps) < 2:
            raise ValueError("a sequence pattern needs at least two steps")
        self.out, self.pattern, self.order, self.payload = out.rstrip("/"), pattern, list(order), list(payload)
        self.before, self.after = before, after
        self.fields = list(dict.fromkeys(self.order + self.payload))
        self.types = {c: schema[c].dataType.simpleString() for c in self.fields}
        self.item = "struct<" + ",".join(f"{c}:{self.types[c]}" for c in self.fields) + ">"
        self.row_schema = schema

    # ---- folders
    def _path(self, what: str, batch_id: int) -> str:
        return f"{self.out}/{what}/batch_id={batch_id:09d}"

    def _read(self, spark: SparkSession, what: str, batch_id: int, schema) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._path(what, batch_id))

    @property
    def _groups(self) -> str:
        return f"{GROUP}, stage int, taken array<{self.item}>"

    @property
    def _starts(self) -> str:
        return f"{GROUP}, own array<{self.item}>"

    # ---- one range of the order
    def _continued(self, ready: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``ready`` with the path that begins at each step's next row; columns of those paths."""
        stats = order_stats(ready, self.order[0])
        order, balanced = self.order, True
        buckets = needs_buckets(stats, df=ready)
        if buckets and not lead_is_balanced(ready, order[0], [], stats, unique=len(order) == 1):
            ready = with_ordinal(ready, order, "__ord")
            order, stats = ["__ord"], order_stats(ready, "__ord")
        cur, names = ready, []
        steps = self.pattern.steps
        for k in range(len(steps) - 1, 0, -1):
            # ordered by the row; the rest of the path rides along as an array of items
            here = F.struct(*[F.col(c) for c in self.fields])
            rest = F.col(f"{names[-1]}.path") if names else F.array().cast(f"array<{self.item}>")
            rest = F.coalesce(rest, F.array().cast(f"array<{self.item}>"))
            found = F.struct(*[F.col(c).alias(f"by_{c}") for c in order], F.concat(F.array(here), rest).alias("path"))
            name = f"__next{k}"
            marked = cur.withColumn(f"__at{k}", F.when(steps[k].condition, found))
            cur = scan(marked, order, {name: ("min", F.col(f"__at{k}"))}, following=True, stats=stats, balanced=balanced,
                       bucket="__gb" if buckets else None)
            names.append(name)
        return cur, names

    def _advance(self, spark: SparkSession, ready: DataFrame, batch_id: int) -> None:
        n = len(self.pattern.steps)
        none = F.array().cast(f"array<{self.item}>")
        cur, names = self._continued(ready)
        ends = [f"__at{k}" for k in range(1, n)]
        cur = cut(cur.withColumn("__start", self.pattern.steps[0].condition).select("__start", names[-1], *self.fields, *ends), "range")
        # the summary: for each step, the first row that satisfies it and how it goes on
        row = cur.agg(*[F.min(f"__at{k}").alias(f"at{k}") for k in range(1, n)])
        summary = row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("stage"), F.col(f"at{k}.path").alias("path")) for k in range(1, n)])).alias("s")).select("s.*")
        starts = cur.where("__start").select(
            F.lit(batch_id).cast("long").alias("born"),
            F.concat(F.array(F.struct(*self.fields)), F.coalesce(F.col(f"{names[-1]}.path"), none)).alias("own"),
        ).withColumn("stage0", F.size("own"))
        whole = starts.where(F.col("stage0") == n).select(F.col("own").alias("path"))
        opened = starts.where(F.col("stage0") < n).select("born", "stage0", "own")
        opened.write.mode("overwrite").partitionBy("stage0").parquet(self._path("starts", batch_id))
        groups = self._read(spark, "groups", batch_id - 1, self._groups)
        moved = groups.join(F.broadcast(summary), "stage", "left")  # one row per step
        moved = moved.withColumn("taken", F.concat("taken", F.coalesce("path", none))).withColumn(
            "stage", (F.col("stage") + F.size(F.coalesce("path", none))).cast("int")
        )
        moved = cut(moved.select("born", "stage0", "stage", "taken"), "groups")
        new = opened.groupBy("born", "stage0").count().select(
            "born", F.col("stage0").cast("int"), F.col("stage0").cast("int").alias("stage"), none.alias("taken")
        )
        moved.where(F.col("stage") < n).unionByName(new).write.mode("overwrite").parquet(self._path("groups", batch_id))
        closed = moved.where(F.col("stage") == n).select("born", "stage0", "taken")
        late = self._open_starts(spark, closed).select(F.concat("own", "taken").alias("path"))
        whole.unionByName(late).write.mode("overwrite").parquet(self._path("matches", batch_id))

    def _open_starts(self, spark: SparkSession, closed: DataFrame) -> DataFrame:
        """The starts of completed groups: only the folders of their batches and steps are read."""
        folders = [(r["born"], r["stage0"]) for r in closed.select("born", "stage0").collect()]  # steps - 1 per batch at most
        found = spark.createDataFrame([], self._starts)
        if folders:
            paths = [f"{self._path('starts', b)}/stage0={s}" for b, s in folders]
            base = f"{self.out}/starts"
            read = spark.read.option("basePath", base).schema(f"born long, own array<{self.item}>, stage0 int, batch_id long").parquet(*paths)
            found = read.select("born", "stage0", "own")
        return found.join(closed, ["born", "stage0"])

    # ---- batches
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cut(drop_late(batch, self.order[0], self.before).select(self.row_schema.names), "pattern-rows")
        held = self._read(spark, "held", batch_id - 1, self.row_schema)
        both = held.unionByName(rows)
        passed = self._passed(spark, batch_id - 1)
        newest = both.agg(F.max(self.after).alias("m")).first()["m"]
        passed = max((v for v in (passed, newest) if v is not None), default=None)
        spark.createDataFrame([(passed,)], "passed long").write.mode("overwrite").parquet(self._path("passed", batch_id))
        self._step(spark, both, batch_id, F.col(self.order[0]) <= F.lit(passed).cast("long"))

    def _passed(self, spark: SparkSession, batch_id: int) -> int | None:
        row = self._read(spark, "passed", batch_id, "passed long").first()
        return None if row is None else row["passed"]

    def _step(self, spark: SparkSession, rows: DataFrame, batch_id: int, due: Column) -> None:
        due = F.coalesce(due, F.lit(False))
        rows.where(~due).write.mode("overwrite").parquet(self._path("held", batch_id))
        self._advance(spark, cut(rows.where(due), "due"), batch_id)

    def end(self, spark: SparkSession, batch_id: int) -> None:
        """End of the stream after batch ``batch_id``: everything that waits is due."""
        self._step(spark, self._read(spark, "held", batch_id, self.row_schema), batch_id + 1, F.lit(True))

    def last_batch(self, spark: SparkSession) -> int:
        from tidemark.streaming.replay import folders

        return max([int(f.split("=")[1]) for f in folders(spark, f"{self.out}/passed")], default=-1)

    def matches(self, spark: SparkSession) -> DataFrame:
        """One row per completed match: ``<step>_<payload>...``."""
        found = spark.read.schema(f"path array<{self.item}>").parquet(f"{self.out}/matches")
        return found.select(
            *[F.col("path")[k][c].alias(f"{s.name}_{c}") for k, s in enumerate(self.pattern.steps) for c in self.payload]
        )
