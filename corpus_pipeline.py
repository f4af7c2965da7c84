"""The corpus pipeline: STAGES over ``documents``, each written and read again.

Language ID, exact dedup, near-dedup (five-word shingles, similarity 0.8), mixing to
target weights, packing.  A stage returns the documents that it keeps, whole and with all
their columns; the mixture adds each row's place in its schedule, and the last returns the packed
pieces, sequences numbered in the order of the mixture.  Stages judge rows: of a doc_id with
several texts only those are dropped that a stage rejects.  Null and empty texts are exact
copies of each other, a null doc_id is never linked, an empty table gives no pieces.

The sketches, the schedule and the packing are not expressible in SQL, so the stages are
tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, langid, mixing, near_dedup, packing
from tidemark.llm.common import cut, read_table
from tidemark.session import scratch_path

#: Words that the last stage's encoder keeps: executors still hold the memory of the stages before it.
PACK_CACHE_WORDS = 60_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.first_copies(docs, exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.scheduled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op3_packing(spark, sf_dir, docs, cache_words=PACK_CACHE_WORDS, order=mixing.MIX_ORDER)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("near-dedup", near),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
