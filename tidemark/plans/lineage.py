"""Lineage cuts for long operator chains.

A two-phase scan reads its input twice (bucket table and body), so a chain of
k scans grows a plan with 2^k copies of its source.  Long chains are cut by
writing the intermediate result as a parquet table into the shared folder
named by ``spark.checkpoint.dir`` and reading it back: one job (unlike an eager
RDD checkpoint, which computes its input twice), a plan that restarts from the
files, column pruning and filter pushdown on the way out, and a lost executor
only recomputes work after the last cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written table."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
