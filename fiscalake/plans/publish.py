"""Validated publication: readers see a complete, count-checked version or the last one."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.plans.lake import GOLD_TABLES, Lake, partitioning, read_table
from fiscalake.session import open_writers
from fiscalake.sources.manifests import read_full_runs, read_ingestion_runs

_POINTER_SCHEMA = "version string, table string, rows bigint"


class PublishError(RuntimeError):
    """A copy does not hold as many rows as its source."""


def _version_path(root: str, version: str, table: str) -> str:
    return f"{root.rstrip('/')}/versions/{version}/{table}"


def _pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> dict[str, int]:
    """Copy every table into a new version, compare counts, then name it current.

    The pointer is one appended file: versions sort by time and the newest named one
    is current. A failure before that leaves the previous version in force, and the
    unnamed folder is never read.
    """
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"
    counts: dict[str, int] = {}
    for name, source in tables.items():
        target = _version_path(root, version, name)
        with open_writers(spark):
            source.write.partitionBy(*partitioning(name)).parquet(target)
        expected, found = source.count(), spark.read.parquet(target).count()
        if expected != found:
            raise PublishError(f"{name}: {expected} rows in the source, {found} in the copy")
        counts[name] = found
    rows = F.array(
        *[
            F.struct(F.lit(version).alias("version"), F.lit(n).alias("table"), F.lit(c).alias("rows"))
            for n, c in counts.items()
        ]
    )
    spark.range(0, 1, 1, 1).select(F.inline(rows)).write.mode("append").json(_pointer_path(root))
    return counts


def current_version(spark: SparkSession, root: str) -> str | None:
    try:
        pointers = spark.read.schema(_POINTER_SCHEMA).json(_pointer_path(root))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return pointers.agg(F.max("version")).first()[0]


def published_counts(spark: SparkSession, root: str) -> DataFrame:
    """(table, rows) of the current version."""
    pointers = spark.read.schema(_POINTER_SCHEMA).json(_pointer_path(root))
    return pointers.where(F.col("version") == current_version(spark, root)).select("table", "rows")


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return read_table(spark, table, _version_path(root, version, table))


def publish_lake(
    lake: Lake,
    root: str,
    ingestion_manifest: str | None = None,
    full_run_manifest: str | None = None,
) -> dict[str, int]:
    """Publish all Gold tables and, where manifests are given, the run tables."""
    tables = lake.tables(GOLD_TABLES)
    if ingestion_manifest is not None:
        tables["ops.ingestion_runs"] = read_ingestion_runs(lake.spark, ingestion_manifest)
    if full_run_manifest is not None:
        tables["ops.pipeline_runs"] = read_full_runs(lake.spark, full_run_manifest)
    return publish(lake.spark, tables, root)
