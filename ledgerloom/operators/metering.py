"""Run outcomes, metered usage and reconciliation of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import run_prefix

# The outcome each kind of run must have.
EXPECTED_OUTCOMES: dict[str, str] = {
    "success": "SUCCEEDED",
    "replay": "SUCCEEDED",
    "conflict": "FAILED",
    "failure": "FAILED",
    "recovery": "SUCCEEDED",
    "tamper": "FAILED",
    "temporal": "FAILED",
    "financial": "FAILED",
}

# Published rates and minimums.
USD_PER_DPU_HOUR = 0.44
USD_PER_TERABYTE = 5.0
BYTES_PER_TERABYTE = 1_000_000_000_000
MINIMUM_SCAN_BYTES = 10 * 1024 * 1024
DEFAULT_WORKERS = 2


def outcome_reconciliation(runs: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    """Expected against actual status per run kind, the text before the first dash of the name.

    `runs` has name, status and seq; the last run of a kind counts.
    """
    wanted = expected or EXPECTED_OUTCOMES
    pairs = [
        F.struct(F.lit(kind).alias("kind"), F.lit(status).alias("expected"))
        for kind, status in wanted.items()
    ]
    table = runs.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    actual = runs.groupBy(run_prefix(F.col("name")).alias("kind")).agg(
        F.max_by("status", "seq").alias("actual")
    )
    return table.join(actual, "kind", "left").select(
        "kind", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("passed")
    )


def result_reconciliation(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(metric, value) frames compared exactly; a metric on one side only does not pass."""
    return (
        expected.select("metric", F.col("value").alias("expected"))
        .join(actual.select("metric", F.col("value").alias("actual")), "metric", "full_outer")
        .withColumn(
            "passed", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))
        )
    )


def usage_metering(job_runs: DataFrame, scans: DataFrame) -> DataFrame:
    """One row of usage and its immediate cost estimate.

    `job_runs` has dpu_seconds (null when not metered), execution_seconds and workers; `scans` has
    bytes. A scan of any bytes is billed for at least 10 MiB, one of none is free.
    """
    workers = F.coalesce(F.col("workers"), F.lit(DEFAULT_WORKERS)).cast("double")
    estimated = F.coalesce(F.col("execution_seconds"), F.lit(0)).cast("double") * workers
    # Runs and scans stacked, so that one aggregation gives the one row.
    usage = job_runs.select(
        F.lit(1).cast("bigint").alias("is_run"),
        F.coalesce(F.col("dpu_seconds"), estimated).alias("dpu"),
        F.lit(None).cast("bigint").alias("bytes"),
    ).unionByName(
        scans.select(
            F.lit(0).cast("bigint").alias("is_run"),
            F.lit(None).cast("double").alias("dpu"),
            F.col("bytes").cast("bigint").alias("bytes"),
        )
    )
    used = F.col("bytes") > 0
    billable = F.when(used, F.greatest(F.col("bytes"), F.lit(MINIMUM_SCAN_BYTES)))
    both = usage.agg(
        F.coalesce(F.sum("is_run"), F.lit(0)).alias("job_runs"),
        F.coalesce(F.sum("dpu"), F.lit(0.0)).alias("dpu"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_scanned"),
        F.count(F.when(used, 1)).alias("scans"),
        F.coalesce(F.sum(billable), F.lit(0)).alias("billable_bytes"),
    )
    compute_usd = F.col("dpu") / 3600 * USD_PER_DPU_HOUR
    scan_usd = F.col("billable_bytes") / F.lit(float(BYTES_PER_TERABYTE)) * USD_PER_TERABYTE
    return both.select(
        "job_runs",
        F.round("dpu", 3).alias("dpu_seconds"),
        "bytes_scanned",
        "scans",
        "billable_bytes",
        F.round(compute_usd, 6).alias("compute_usd"),
        F.round(scan_usd, 6).alias("scan_usd"),
        F.round(compute_usd + scan_usd, 6).alias("total_usd"),
    )
