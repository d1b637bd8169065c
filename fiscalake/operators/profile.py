"""Profiles of raw Bronze data: value quality and schema drift.

Results are rows rather than lists, so that no list has to fit on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.functions.parse import br_date, br_decimal, exact_month_number
from fiscalake.functions.paths import path_month, path_year_text, snapshot_name
from fiscalake.functions.text import is_blank, is_filled
from fiscalake.operators.quality import duplicate_groups
from fiscalake.sources.schemas import (
    BRONZE_COLUMNS,
    EXPENSES,
    MONEY_COLUMN,
    SOURCE_PATH,
    known_dataset,
)
from fiscalake.sources.snapshots import list_files, read_arrays


def _counters(dataset: str) -> dict[tuple[str, str | None], Column]:
    columns = BRONZE_COLUMNS[dataset]
    money = F.col(MONEY_COLUMN[dataset])
    month = exact_month_number(F.col("mes"))
    counters = {("total_records", None): F.count(F.lit(1))}
    for name in columns:
        counters[("null_or_empty", name)] = F.count_if(is_blank(F.col(name)))
    counters[("invalid_months", "mes")] = F.count_if(month.isNull())
    counters[("partition_month_mismatches", "mes")] = F.count_if(
        ~month.eqNullSafe(path_month(F.col(SOURCE_PATH)))
    )
    counters[("invalid_monetary_values", MONEY_COLUMN[dataset])] = F.count_if(
        is_filled(money) & br_decimal(money).isNull()
    )
    if dataset == EXPENSES:
        issued = F.col("dt_emissao_despesa")
        counters[("invalid_dates", "dt_emissao_despesa")] = F.count_if(
            is_filled(issued) & br_date(issued).isNull()
        )
    return counters


def duplicate_contents(bronze: DataFrame, dataset: str, with_municipality: bool = False) -> DataFrame:
    """Repeated record contents within a year.

    The year comes from the path because revenue records do not carry it. The
    municipality is left out unless asked for; add it when profiling several.
    """
    path = F.col(SOURCE_PATH)
    keys = [F.col(name) for name in BRONZE_COLUMNS[dataset]]
    keys.append(path_year_text(path).alias("exercicio"))
    if with_municipality:
        keys.append(F.regexp_extract(path, "municipio=([^/]+)", 1).alias("municipio"))
    return duplicate_groups(bronze, keys)


def quality_profile(bronze: DataFrame, dataset: str, with_municipality: bool = False) -> DataFrame:
    """(metric, column, value): every counter from one pass, duplicates from a second.

    ``column`` is the column a counter is about, NULL for counters of whole records.
    """
    counters = _counters(known_dataset(dataset))
    counted = bronze.agg(*[count.alias(f"c{i}") for i, count in enumerate(counters.values())])
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).cast("string").alias("column"),
            F.col(f"c{i}").alias("value"),
        )
        for i, (metric, column) in enumerate(counters)
    ]
    duplicates = duplicate_contents(bronze, dataset, with_municipality).agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum(F.col("quantidade") - 1), F.lit(0)).alias("excess"),
    )
    of_duplicates = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(None).cast("string").alias("column"), F.col(name).alias("value")
        )
        for metric, name in (("exact_duplicate_groups", "groups"), ("exact_duplicate_excess_rows", "excess"))
    ]
    return counted.select(F.inline(F.array(*rows))).unionByName(
        duplicates.select(F.inline(F.array(*of_duplicates)))
    )


def distinct_values(bronze: DataFrame, dataset: str) -> DataFrame:
    """(column, value): the distinct months and, for expenses, the distinct events.

    Both columns go through one scan and one shuffle; ``orderBy`` it for a report.
    """
    names = ["mes", "evento"] if known_dataset(dataset) == EXPENSES else ["mes"]
    pairs = [F.struct(F.lit(n).alias("column"), F.col(n).alias("value")) for n in names]
    return (
        bronze.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    )


def read_record_texts(
    spark: SparkSession, bronze_root: str, dataset: str, files: DataFrame | None = None
) -> DataFrame:
    """(file, record): every record of every snapshot as JSON text, nothing typed.

    A file is a snapshot: one array file, or a folder of part files. Fails on a top level
    that is not a list and on an item that is no object.
    """
    listed = list_snapshots(spark, bronze_root, dataset) if files is None else files
    arrays = read_arrays(spark, [row.path for row in listed.toLocalIterator()])
    name = snapshot_name(F.col("path"))
    items = F.when(
        F.json_array_length("value").isNotNull(), F.from_json("value", "array<string>")
    ).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON list: "), F.col("path"))).cast("array<string>")
    )
    return arrays.select(name.alias("file"), F.explode(items).alias("record"))


def record_keys(records: DataFrame) -> DataFrame:
    """(file, schema_keys): sorted field names of each record, comma-separated."""
    keys = F.json_object_keys("record")
    checked = F.when(keys.isNotNull(), keys).otherwise(
        F.raise_error(F.concat(F.lit("record is not an object in "), F.col("file"))).cast(
            "array<string>"
        )
    )
    return records.select("file", F.array_join(F.array_sort(checked), ",").alias("schema_keys"))


def schema_profile(records: DataFrame) -> DataFrame:
    """(schema_keys, files, records): every set of fields in use.

    Counted per (schema, file) first: the schema nearly all records share is
    reduced on the map side before it meets in one group.
    """
    per_file = record_keys(records).groupBy("schema_keys", "file").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_file.groupBy("schema_keys").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("records")
    )


def schema_files(records: DataFrame) -> DataFrame:
    """(schema_keys, file): which file holds which set of fields."""
    return record_keys(records).select("schema_keys", "file").distinct()


def list_snapshots(spark: SparkSession, bronze_root: str, dataset: str) -> DataFrame:
    """(path) of every snapshot of a dataset, empty ones included."""
    return list_files(spark, bronze_root, dataset).select(F.col("snapshot").alias("path")).distinct()


def empty_files(files: DataFrame, records: DataFrame) -> DataFrame:
    """Listed files without any record."""
    return files.join(records.select(F.col("file").alias("path")).distinct(), "path", "left_anti")


def schema_totals(files: DataFrame, records: DataFrame) -> DataFrame:
    """(files, records, empty_files) in one row."""
    per_file = records.groupBy(F.col("file").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return files.join(per_file, "path", "left").agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count_if(F.col("n").isNull()).alias("empty_files"),
    )


def profile_dataset_schema(
    spark: SparkSession, bronze_root: str, dataset: str
) -> dict[str, DataFrame]:
    """Schema profile of a Bronze dataset: totals, sets of fields, their files, empty files."""
    files = list_snapshots(spark, bronze_root, dataset)
    records = read_record_texts(spark, bronze_root, dataset, files)
    return {
        "totals": schema_totals(files, records),
        "schemas": schema_profile(records),
        "schema_files": schema_files(records),
        "files": files,
        "empty_files": empty_files(files, records),
    }
