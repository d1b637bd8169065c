"""Published versions that share files.

A table is published in parts, by year where it is stored by year. A version lists the
folder of each part with its rows and the sum of their hashes. A part whose count and sum
are those of the version before is named again, not copied; other parts are written anew,
counted where they lie, and the list is appended last. So a version costs what has changed,
an earlier one still reads, and ``retain`` drops the folders that no kept version names.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fiscalake.plans.lake import partitioning
from fiscalake.plans.publish import PublishError
from fiscalake.sources.folders import delete_folders

WHOLE = "all"
_SCHEMA = "version string, table string, part string, folder string, rows bigint, high decimal(38,0), low decimal(38,0), schema string"


def _list_path(root: str) -> str:
    return f"{root.rstrip('/')}/parts"


def listed_parts(spark: SparkSession, root: str) -> DataFrame:
    """A row for each part of each version that is kept."""
    try:
        rows = spark.read.schema(_SCHEMA).json(_list_path(root))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _SCHEMA)
        raise
    # the row that says a version is dropped has no folder
    dropped = rows.where(F.col("folder").isNull()).select("version").distinct()
    return rows.where(F.col("folder").isNotNull()).join(dropped, "version", "left_anti").select(*rows.columns)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Versions that are kept, oldest first."""
    return sorted(r[0] for r in listed_parts(spark, root).select("version").distinct().collect())


def _part(table: str) -> Column:
    years = partitioning(table)
    return F.coalesce(F.col(years[0]).cast("string"), F.lit("none")) if years else F.lit(WHOLE)


def _sums(df: DataFrame, part: Column) -> dict[str, tuple]:
    """(rows, high, low) of each part: as many as the table has years."""
    told = [x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]
    hashed = df.select(part.alias("part"), F.xxhash64(*told).alias("h"))
    wide = lambda c: F.sum(c.cast("decimal(20,0)")).cast("decimal(38,0)")
    found = hashed.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        wide(F.shiftrightunsigned("h", 32)).alias("high"),
        wide(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )
    return {r["part"]: (r["rows"], r["high"], r["low"]) for r in found.collect()}


def publish_version(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> str:
    """Publish ``tables`` as a new version and return its name."""
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"
    kept = versions(spark, root)
    before = {}
    if kept:
        for r in listed_parts(spark, root).where(F.col("version") == kept[-1]).collect():
            before[r["table"], r["part"], r["schema"]] = ((r["rows"], r["high"], r["low"]), r["folder"])
    listed = []
    for table, df in tables.items():
        sums, schema, target = _sums(df, _part(table)), df.schema.json(), f"{root.rstrip('/')}/files/{version}/{table}"
        held = {part: before.get((table, part, schema), (None, None)) for part in sums}
        new = [part for part, now in sums.items() if held[part][0] != now]
        if new:
            df.withColumn("_part", _part(table)).where(F.col("_part").isin(new)).write.partitionBy("_part").parquet(target)
        for part, now in sums.items():
            folder = f"{target}/_part={part}" if part in new else held[part][1]
            if part in new and (found := spark.read.schema(df.schema).parquet(folder).count()) != now[0]:
                raise PublishError(f"{table} {part}: {now[0]} rows in the source, {found} in the copy")
            listed.append((version, table, part, folder, *now, schema))
        if not sums:  # an empty table is named all the same
            df.write.parquet(f"{target}/_part={WHOLE}")
            listed.append((version, table, WHOLE, f"{target}/_part={WHOLE}", 0, None, None, schema))
    spark.createDataFrame(listed, _SCHEMA).coalesce(1).write.mode("append").json(_list_path(root))
    return version


def read_version(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """A table as a version published it, the newest one if not named."""
    kept = versions(spark, root)
    if not kept or version not in (None, *kept):
        raise FileNotFoundError(f"no version {version or ''} of {table} at {root}")
    chosen = (F.col("version") == (version or kept[-1])) & (F.col("table") == table)
    parts = listed_parts(spark, root).where(chosen).collect()
    if not parts:
        raise FileNotFoundError(f"{table} is not published at {root}")
    schema = StructType.fromJson(json.loads(parts[0]["schema"]))
    return spark.read.schema(schema).parquet(*[r["folder"] for r in parts])


def retain(spark: SparkSession, root: str, last: int) -> list[str]:
    """Keep the ``last`` versions; the folders that no kept version names, now deleted."""
    gone = versions(spark, root)[:-last]
    if not gone:
        return []
    parts = listed_parts(spark, root)
    named = {r[0] for r in parts.where(~F.col("version").isin(gone)).select("folder").collect()}
    unused = sorted({r[0] for r in parts.where(F.col("version").isin(gone)).select("folder").collect()} - named)
    # first no longer named, then deleted: a reader finds a version whole or not at all
    rows = [(version, None, None, None, None, None, None, None) for version in gone]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").json(_list_path(root))
    delete_folders(spark, unused)
    return unused
