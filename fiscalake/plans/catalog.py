"""Catalog tables: the lake by name, laid out for its joins.

Schemas ``silver``, ``gold`` and ``ops`` hold the tables of a lake under the names that
models use. The expense fact and the supplier dimension are bucketed and sorted by the
supplier's key, so they join, and the fact is summed by supplier, without moving the fact.
Column statistics let Catalyst judge sizes after filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fiscalake.plans.lake import GOLD_TABLES, SILVER_TABLES, Lake

#: Columns that tables are bucketed by; both sides of a join have the same number of buckets.
BUCKETED = {"fct_despesas": "fornecedor_sk", "dim_fornecedor": "fornecedor_sk"}
BUCKETS = 64


def layer_of(table: str) -> str:
    if table.startswith("ops."):
        return "ops"
    return "silver" if table in SILVER_TABLES else "gold"


def table_name(table: str, prefix: str = "") -> str:
    """``<prefix><layer>.<table>``; the prefix tells lakes of one catalog apart."""
    return f"{prefix}{layer_of(table)}.{table.removeprefix('ops.')}"


def register(
    spark: SparkSession, table: str, df: DataFrame, prefix: str = "", buckets: int = BUCKETS
) -> str:
    """Store ``df`` as a catalog table with statistics, replacing it; the table's name."""
    name = table_name(table, prefix)
    spark.sql(f"create database if not exists {name.split('.')[0]}")
    writer = df.write.mode("overwrite").format("parquet")
    if table in BUCKETED:
        key = BUCKETED[table]
        # one task for each bucket: else every task would write a file of every bucket
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)
    spark.sql(f"analyze table {name} compute statistics for all columns")
    return name


def register_lake(
    lake: Lake, prefix: str = "", tables: Sequence[str] = SILVER_TABLES + GOLD_TABLES, buckets: int = BUCKETS
) -> dict[str, str]:
    """All tables of a lake by name: table to its name in the catalog."""
    return {t: register(lake.spark, t, lake.read(t), prefix, buckets) for t in tables}


def read(spark: SparkSession, table: str, prefix: str = "") -> DataFrame:
    return spark.table(table_name(table, prefix))


def drop_lake(spark: SparkSession, prefix: str) -> None:
    """Drop the schemas of a prefix with all their tables."""
    for layer in ("silver", "gold", "ops"):
        spark.sql(f"drop database if exists {prefix}{layer} cascade")
