"""Reading on where a manifest was read to.

Manifests only grow: by new files, or by lines at the end of one. A state says of each
file how long it was, when it was written, how many lines were read and the sum of their
hashes. A file as long and as old as then is not opened. Of a longer one the lines read
before are only hashed, to see that they are the same ones, and the lines after them are
parsed, under their right numbers. A file that got shorter, or whose earlier lines are other
ones, was rewritten: reading it on would skip or repeat runs, so it is an error.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.functions.paths import literal_path, plain_path
from fiscalake.session import scratch_path
from fiscalake.sources.manifests import ManifestError, ParsedRuns, numbered_lines

_STATE = "file string, bytes bigint, modified timestamp, lines bigint, digest decimal(38,0), read_no bigint"


@dataclass(frozen=True)
class Tail:
    """Runs and rejects of lines not read before; ``commit`` notes that they were taken over."""

    parsed: ParsedRuns
    lines: DataFrame
    commit: Callable[[], None]


def _read_state(spark: SparkSession, path: str) -> DataFrame:
    try:
        noted = spark.read.schema(_STATE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _STATE)
        raise
    last = F.max(F.struct("read_no", "bytes", "modified", "lines", "digest")).alias("last")
    return noted.groupBy("file").agg(last).select("file", "last.*")


def _listed(spark: SparkSession, manifest_path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{json,jsonl,txt}")
        .load(manifest_path)
        .select(
            plain_path(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_size").alias("now_bytes"),
            F.col("_metadata.file_modification_time").alias("now_modified"),
        )
    )


def read_tail(
    spark: SparkSession, manifest_path: str, state_path: str, parse: Callable[[DataFrame], ParsedRuns]
) -> Tail:
    """The lines below ``manifest_path`` that were not read before, parsed by ``parse``.

    The names of new and grown files come to the driver, as they go to the reader.
    """
    state = _read_state(spark, state_path)
    files = _listed(spark, manifest_path).join(state, "file", "left")
    changed = files.where(
        F.col("bytes").isNull() | (F.col("bytes") != F.col("now_bytes")) | (F.col("modified") != F.col("now_modified"))
    ).select("file", "now_bytes", "now_modified", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), "digest", "read_no")
    path = scratch_path(spark, "manifest-files")
    changed.write.parquet(path)
    changed = spark.read.schema(changed.schema).parquet(path)
    names = [r["file"] for r in changed.select("file").toLocalIterator()]
    if not names:
        lines = spark.createDataFrame([], "file string, line_number bigint, line string")
        return Tail(parse(lines), lines, lambda: None)

    every = numbered_lines(spark, [literal_path(name) for name in names]).join(
        changed.select("file", F.col("lines").alias("read")), "file"
    )
    path = scratch_path(spark, "manifest-sums")
    value = F.xxhash64("line_number", "line").cast("decimal(38,0)")
    total = lambda rows: F.coalesce(F.sum(F.when(rows, value)), F.lit(0)).cast("decimal(38,0)")
    everything = F.lit(True)
    sums = every.groupBy("file").agg(
        F.count(F.lit(1)).alias("all_lines"),
        total(everything).alias("all_digest"),
        total(F.col("line_number") <= F.col("read")).alias("old_digest"),
    )
    changed.join(sums, "file", "left").write.parquet(path)
    judged = spark.read.parquet(path)
    known = F.col("bytes").isNotNull()
    other = (F.coalesce("all_lines", F.lit(0)) < F.col("lines")) | (F.coalesce("old_digest", F.lit(0)) != F.col("digest"))
    rewritten = judged.where(known & other).select("file").orderBy("file").take(1)
    if rewritten:
        raise ManifestError(f"{rewritten[0]['file']}: lines that were read before have changed")

    def commit() -> None:
        zero = F.lit(0)
        judged.select(
            "file",
            F.col("now_bytes").alias("bytes"),
            F.col("now_modified").alias("modified"),
            F.coalesce("all_lines", zero).cast("bigint").alias("lines"),
            F.coalesce("all_digest", zero).cast("decimal(38,0)").alias("digest"),
            (F.coalesce("read_no", zero) + 1).cast("bigint").alias("read_no"),
        ).write.mode("append").parquet(state_path)

    lines = every.where(F.col("line_number") > F.col("read")).select("file", "line_number", "line")
    return Tail(parse(lines), lines, commit)
