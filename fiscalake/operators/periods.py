"""Period plans: which months of which dataset are to be loaded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.sources.schemas import EXPENSES, REVENUES

DATASETS = (EXPENSES, REVENUES)


def _check_period(start_year: int, end_year: int, end_month: int) -> None:
    if start_year > end_year:
        raise ValueError(f"start year {start_year} is after end year {end_year}")
    if not 1 <= end_month <= 12:
        raise ValueError(f"end month {end_month} is not between 1 and 12")


def with_months(rows: DataFrame, start_year: int, end_year: int, end_month: int = 12) -> DataFrame:
    """Repeat each row for every month from January of the start year to the end month."""
    _check_period(start_year, end_year, end_month)
    months = F.sequence(F.lit(start_year * 12), F.lit(end_year * 12 + end_month - 1))
    return (
        rows.withColumn("_m", F.explode(months))
        .withColumn("exercicio", F.floor(F.col("_m") / 12).cast("int"))
        .withColumn("mes", (F.col("_m") % 12 + 1).cast("int"))
        .drop("_m")
    )


def period_plan(
    spark: SparkSession, start_year: int, end_year: int, end_month: int = 12
) -> DataFrame:
    return with_months(spark.range(0, 1, 1, 1), start_year, end_year, end_month).select(
        "exercicio", "mes"
    )


def recurring_range(today: date, previous_year: bool = True) -> tuple[int, int, int]:
    """First year, last year and last month of a recurring load."""
    return (today.year - 1 if previous_year else today.year), today.year, today.month


def recurring_plan(spark: SparkSession, today: date, previous_year: bool = True) -> DataFrame:
    """The current year to date, with the whole previous year unless switched off."""
    return period_plan(spark, *recurring_range(today, previous_year))


def load_plan(plan: DataFrame, datasets: Sequence[str] = DATASETS) -> DataFrame:
    """Every planned month of every dataset."""
    names = F.array(*[F.lit(name) for name in datasets])
    return plan.withColumn("dataset", F.explode(names))


def missing_periods(plan: DataFrame, runs: DataFrame) -> DataFrame:
    """Planned loads without a run that succeeded or came back empty.

    Runs shrink to one row per load before the anti join.
    """
    done = (
        runs.where(F.col("status").isin("success", "empty"))
        .select(
            "dataset",
            F.col("municipality").alias("municipio"),
            F.col("year").alias("exercicio"),
            F.col("month").alias("mes"),
        )
        .distinct()
    )
    return plan.join(done, ["dataset", "municipio", "exercicio", "mes"], "left_anti")
