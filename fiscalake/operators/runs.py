"""Indicators over the run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.parse import micros_between


def _with_status(status: str):
    return F.count_if(F.col("status") == status)


def batch_summary(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs by outcome, in total or per group of ``keys``."""
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        _with_status("success").alias("success"),
        _with_status("empty").alias("empty"),
        _with_status("failed").alias("failed"),
    )


def extraction_indicators(runs: DataFrame) -> DataFrame:
    """One row: last extraction, calls by outcome, records, mean duration.

    The mean comes from whole microseconds, so it does not depend on the order in
    which partial sums meet.
    """
    spent = micros_between(F.col("started_at_utc"), F.col("completed_at_utc"))
    return runs.agg(
        F.max("completed_at_utc").alias("last_extraction_at"),
        F.count(F.lit(1)).alias("calls"),
        _with_status("success").alias("calls_success"),
        _with_status("empty").alias("calls_empty"),
        _with_status("failed").alias("calls_failed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records_processed"),
        (F.sum(spent) / F.count(spent) / F.lit(1e6)).alias("mean_duration_seconds"),
    )


def last_full_run(runs: DataFrame) -> DataFrame:
    """One row: the run of the whole job that ended last."""
    fields = ("run_id", "status", "dry_run", "completed_at_utc", "duration_seconds", "failed_stage")
    place = [c for c in ("manifest_file", "manifest_line_number") if c in runs.columns]
    order = F.struct("completed_at_utc", *place)
    return (
        runs.where(F.col("completed_at_utc").isNotNull())
        .agg(F.max_by(F.struct(*fields), order).alias("last"))
        .where(F.col("last").isNotNull())
        .select(*[F.col(f"last.{name}").alias(name) for name in fields])
    )


def full_run_summary(runs: DataFrame) -> DataFrame:
    """Full runs by outcome and kind (real or dry)."""
    return runs.groupBy("status", "dry_run").agg(F.count(F.lit(1)).alias("runs"))
