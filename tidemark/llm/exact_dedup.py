"""Exact dedup (9): a persistent digest index, bucketed and sorted by hash.

``DigestIndex`` is a table ``(digest, keep_id, copies)`` of one row per
distinct normalised text, written with ``bucketBy(digest).sortBy(digest)``.  A
batch of documents is reduced to one row per digest (map-side aggregate, so a
group holding a third of all rows costs one row per task), anti-joined to the
index by sort-merge on the digest, and its new digests are appended as a further
segment of the same table.  Only digests move; texts are read once.

Texts are equal when they are identical after every run of space or 0x09-0x0D
became one space (nothing is trimmed); null counts as empty.  Of equal texts
the smallest doc_id stays.  Cases: a null doc_id never stays before another
id and, alone, has a null keep_id and kept = false unless all of its group is
null (then kept = true: nothing else carries the text); rows that repeat a doc_id and text count as
copies and share its verdict; an empty table gives an empty result; other
columns are ignored, whatever they are called.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import cut, read_table, split_by_ids
from tidemark.session import scratch_path

#: White space that normalisation collapses (fixed value).
SPACE = r"[\x20\x09-\x0D]+"
BUCKETS = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` of every row, written: the only pass over the texts."""
    return cut(docs.select("doc_id", digest(F.col("text")).alias("digest")), "digests")


class DigestIndex:
    """The persistent index under ``path``; any session can open it again."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, copies BIGINT) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, batch: DataFrame) -> DataFrame:
        """Add the digests of ``batch`` (doc_id, digest) that are new; returns them.

        Appending a batch again adds nothing, so a restarted job may repeat it.
        """
        found = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("copies"))
        known = self.rows().select(F.col("digest").alias("known"))
        new = found.join(known.hint("merge"), F.col("digest") == F.col("known"), "left_anti")
        new = cut(new.select("digest", F.col("keep_id").cast("long").alias("keep_id"), "copies"), "new-digests")
        (
            new.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        return new

    def groups(self) -> DataFrame:
        """All index rows by a plain read of its files.

        Read without the bucket layout, so that a join to documents shuffles both
        sides and Spark may split a digest that holds a large share of the rows.
        """
        return self.spark.read.schema("digest binary, keep_id long, copies long").parquet(self.path)


def exact_duplicates(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` is appended to ``index`` first.  A text that an earlier batch brought
    keeps that batch's id: then no row of this batch is kept.
    """
    found = digests(docs)
    index.append(found)
    groups = index.groups().select(F.col("digest").alias("d"), "keep_id", "copies")
    return found.join(groups, F.col("digest") == F.col("d"), "left").select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def first_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """``docs`` without the rows that exact dedup drops, each known by its doc_id and text.

    Another text of a dropped row's doc_id stays.  Only rows whose doc_id may be a dropped one's
    are joined, so nearly all texts stay where they are.
    """
    verdict = exact_duplicates(docs, index).filter(~F.col("kept")).select("doc_id", "text_sha256")
    verdict = cut(verdict.distinct().withColumn("text_sha256", F.unhex("text_sha256")), "copies")
    some, others = split_by_ids(docs, "doc_id", verdict.select("doc_id"))
    gone = verdict.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__gone"))
    # the digest is no join key: it is computed for the rows whose doc_id is found
    same = F.array_contains(F.array("__gone"), digest(some["text"]))
    kept = some.join(gone, (some["doc_id"] == gone["__id"]) & same, "left_anti")
    if not verdict.filter("doc_id IS NULL").isEmpty():
        gone = verdict.filter("doc_id IS NULL").select(F.col("text_sha256").alias("__gone"))  # they have a kept twin
        kept = kept.join(gone, kept["doc_id"].isNull() & (digest(kept["text"]) == gone["__gone"]), "left_anti")
    return others.unionByName(kept)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_duplicates(docs, DigestIndex(spark, scratch_path(spark, "digest-index")))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM t
"""
