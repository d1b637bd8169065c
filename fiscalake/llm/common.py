"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalake.session import scratch_path

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_PER_BATCH = 500

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    Inside a lambda function an expression is evaluated for every element, a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: lineage ends, executors may be lost.

    Python tasks get their rows in small batches meanwhile: rows hold whole texts.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, ROWS_PER_BATCH)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def use_small_batches(spark: SparkSession) -> None:
    """Hand rows with whole texts to Python tasks in small batches, here and later in the session."""
    if not 0 < int(spark.conf.get(_BATCH)) <= ROWS_PER_BATCH:
        spark.conf.set(_BATCH, ROWS_PER_BATCH)


def text_slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``most_bytes`` bytes of text; a longer text is a slice of its own."""
    start, held = 0, 0
    for k, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if held and held + size > most_bytes:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def release_memory() -> None:
    """Give freed memory back to the system: Spark's Python workers live on for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` for ``mapInArrow``, with its memory given back when it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release_memory()

    return run


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, from 0 within each group in ``order``, and ``n``, the group's rows.

    Rows are sorted by ranges of group and order, so that a group with most of all rows goes to
    many tasks; a range's rows before a group's first row are counted afterwards. Rows that are
    equal in ``order`` get their positions in any way. Group columns must not be null. ``rows``
    must be stored or deterministic. Stored below ``name``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are told apart by where they were read, so that ranges can cut among them
    keys = [*group, *order, "seq"]
    ranged = (
        rows.withColumn("seq", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("seq", F.monotonically_increasing_id())
    )
    held = stored(ranged.withColumn("range", F.shiftright("seq", 33)), name)
    firsts = held.groupBy(*group, "range").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("in_range"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    firsts = firsts.select(
        *group,
        "range",
        (F.sum("in_range").over(upto) - F.col("in_range") - F.col("first")).alias("shift"),
        F.sum("in_range").over(whole).alias("n"),
    )
    # a range's rows of a group are at most one task's rows: no key is hotter than that
    return (
        held.join(stored(firsts, f"{name}-ranges"), [*group, "range"])
        .withColumn("pos", F.col("seq") + F.col("shift"))
        .drop("seq", "range", "shift")
    )
