"""Plan shape: global scans shuffle by bucket, scans read only needed columns."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_stamp_is_bucketed_not_single_partition(spark):
    plan = _plan(entry.queries()["wm_prefix_max"](spark, SF))
    assert "hashpartitioning(__b0" in plan  # rows are spread by bucket of the arrival order
    # every window is either partitioned by the bucket (the rows) or ordered by
    # the bucket (the small bucket table); none orders the raw rows globally
    specs = [line.split("windowspecdefinition(", 1)[1] for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert specs and all(spec.startswith("__b") for spec in specs)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["seq_match_keyed"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("props" not in s and "value" not in s.split("ReadSchema")[-1] for s in scans)
