"""Run manifests: JSON Lines read with line numbers, validated and typed.

Every line is either a typed run or a reject with its reason; nothing is dropped
silently. ``strict`` readers raise on the first reject.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalake.functions.parse import ASCII_WHITESPACE, iso_timestamp, seconds_between
from fiscalake.functions.paths import plain_path
from fiscalake.session import use_checkpoints

# Statuses and the keys every line must have.
INGESTION_STATUSES = ("success", "empty", "failed")
INGESTION_KEYS = ("run_id", "status", "dataset", "municipality", "year", "month")
FULL_RUN_STATUSES = ("success", "failed")
FULL_RUN_KEYS = (
    "run_id",
    "execution_source",
    "status",
    "dry_run",
    "started_at_utc",
    "completed_at_utc",
    "duration_seconds",
)

_INGESTION_RECORD = ", ".join(
    f"{name} string"
    for name in (
        *INGESTION_KEYS,
        "source_url",
        "record_count",
        "content_length_bytes",
        "sha256",
        "started_at_utc",
        "completed_at_utc",
        "extracted_at_utc",
        "output_path",
        "error_type",
        "error_message",
    )
)
_FULL_RUN_RECORD = (
    "run_id string, execution_source string, status string, dry_run boolean, "
    "started_at_utc string, completed_at_utc string, duration_seconds string, "
    "failed_stage string, error_message string"
)

FULL_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("execution_source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("dry_run", T.BooleanType()),
        T.StructField("started_at_utc", T.TimestampType()),
        T.StructField("completed_at_utc", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("failed_stage", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("manifest_line_number", T.LongType()),
        T.StructField("manifest_file", T.StringType()),
    ]
)


class ManifestError(ValueError):
    """A manifest line that cannot be used."""


@dataclass(frozen=True)
class ParsedRuns:
    runs: DataFrame
    rejects: DataFrame


def numbered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line_number, line): 1-based line numbers, counted block by block.

    A large file is read by many tasks. The lines before a block are summed from the
    blocks' line counts, so no task sees a whole file. The checkpoint fixes the
    blocks: counting and numbering must see the same ones even if the scan would be
    split differently a second time.
    """
    use_checkpoints(spark)
    lines = (
        spark.read.text(paths if isinstance(paths, str) else list(paths))
        .select(
            plain_path(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
            F.col("value").alias("line"),
        )
        .checkpoint()
    )
    blocks = lines.groupBy("file", "block").agg(
        F.min("position").alias("first_position"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "file",
        "block",
        "first_position",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lines_before"),
    )
    number = F.col("lines_before") + F.col("position") - F.col("first_position") + 1
    return lines.join(offsets, ["file", "block"]).select(
        "file", number.alias("line_number"), "line"
    )


def _first_reason(*reasons: tuple[Column, Column | str]) -> Column:
    """The first reason whose condition holds, else NULL."""
    return F.coalesce(
        *[F.when(cond, F.lit(text) if isinstance(text, str) else text) for cond, text in reasons]
    )


def _shape_reasons(keys: Sequence[str]) -> list[tuple[Column, Column | str]]:
    found = F.col("p.keys")
    missing = F.array_sort(F.array_except(F.array(*[F.lit(k) for k in keys]), found))
    return [
        (F.col("p.text") == "", "blank line"),
        # Parsed in full only where the line has no keys.
        (found.isNull() & F.try_parse_json(F.col("p.text")).isNull(), "invalid JSON"),
        (found.isNull(), "not a JSON object"),
        (F.size(missing) > 0, F.concat(F.lit("missing keys: "), F.array_join(missing, ", "))),
    ]


def _bad_status(statuses: Sequence[str]) -> tuple[Column, Column]:
    status = F.col("r.status")
    return (
        ~F.coalesce(status.isin(list(statuses)), F.lit(False)),
        F.concat(F.lit("unknown status: "), F.coalesce(status, F.lit("null"))),
    )


def _unparsed(raw: str, parsed: Column) -> Column:
    """Filled text that did not convert."""
    return (F.coalesce(F.col(raw), F.lit("")) != "") & parsed.isNull()


def _split(lines: DataFrame, record: str, reason: Column, typed: Sequence[Column]) -> ParsedRuns:
    """Parse each line once and sort it into runs and rejects.

    Both keep the number of the line and, where lines come from files, the file: only
    together do they name one line. The one-element explode keeps the parsed line a value of its own: the optimizer
    would otherwise repeat the parsing for every condition that looks at it.
    """
    text = F.col("text")
    parsed = F.struct(
        text,
        F.json_object_keys(text).alias("keys"),
        F.from_json(text, record).alias("r"),
    )
    place = [F.col("line_number").cast("bigint").alias("manifest_line_number")]
    if "file" in lines.columns:
        place.append(F.col("file").alias("manifest_file"))
    names = ["manifest_line_number", "manifest_file"][: len(place)]
    judged = (
        lines.select(*place, F.btrim("line", F.lit(ASCII_WHITESPACE)).alias("text"))
        .select(*names, F.explode(F.array(parsed)).alias("p"))
        .select(*names, "p", F.col("p.r").alias("r"))
        .withColumn("reason", reason)
    )
    return ParsedRuns(
        runs=judged.where(F.col("reason").isNull()).select(*typed, *names),
        rejects=judged.where(F.col("reason").isNotNull()).select(
            names[0], "reason", *names[1:]
        ),
    )


def parse_ingestion_runs(lines: DataFrame) -> ParsedRuns:
    """Typed ingestion runs from (line_number, line).

    Required keys must exist; year and month must be integers. A missing record
    count is 0 and the end time falls back to the extraction time.
    """
    year, month = (F.col(f"r.{n}").try_cast("int") for n in ("year", "month"))
    started = iso_timestamp(F.col("r.started_at_utc"))
    ended_text = F.coalesce(
        F.nullif(F.col("r.completed_at_utc"), F.lit("")), F.col("r.extracted_at_utc")
    )
    ended = iso_timestamp(ended_text)
    counted = F.col("r.record_count").try_cast("bigint")
    size = F.col("r.content_length_bytes").try_cast("bigint")
    reason = _first_reason(
        *_shape_reasons(INGESTION_KEYS),
        _bad_status(INGESTION_STATUSES),
        (year.isNull() | month.isNull(), "year and month must be integers"),
        (
            _unparsed("r.record_count", counted) | _unparsed("r.content_length_bytes", size),
            "counters must be integers",
        ),
        (
            _unparsed("r.started_at_utc", started)
            | ((F.coalesce(ended_text, F.lit("")) != "") & ended.isNull()),
            "invalid timestamp",
        ),
    )
    return _split(
        lines,
        _INGESTION_RECORD,
        reason,
        [
            F.col("r.run_id").alias("run_id"),
            F.col("r.status").alias("status"),
            F.col("r.dataset").alias("dataset"),
            F.col("r.municipality").alias("municipality"),
            year.alias("year"),
            month.alias("month"),
            F.col("r.source_url").alias("source_url"),
            F.coalesce(counted, F.lit(0)).cast("bigint").alias("record_count"),
            size.alias("content_length_bytes"),
            F.col("r.sha256").alias("sha256"),
            started.alias("started_at_utc"),
            ended.alias("completed_at_utc"),
            seconds_between(started, ended).alias("duration_seconds"),
            F.col("r.output_path").alias("output_path"),
            F.col("r.error_type").alias("error_type"),
            F.col("r.error_message").alias("error_message"),
        ],
    )


def parse_full_runs(lines: DataFrame) -> ParsedRuns:
    """Typed runs of the whole job from (line_number, line).

    ``dry_run`` must be a JSON boolean: a text such as ``"false"`` is a reject rather
    than true.
    """
    started = iso_timestamp(F.col("r.started_at_utc"))
    ended = iso_timestamp(F.col("r.completed_at_utc"))
    duration = F.col("r.duration_seconds").try_cast("double")
    reason = _first_reason(
        *_shape_reasons(FULL_RUN_KEYS),
        _bad_status(FULL_RUN_STATUSES),
        (F.col("r.dry_run").isNull(), "dry_run must be a boolean"),
        (started.isNull() | ended.isNull(), "invalid timestamp"),
        (duration.isNull(), "duration_seconds must be a number"),
    )
    return _split(
        lines,
        _FULL_RUN_RECORD,
        reason,
        [
            F.col("r.run_id").alias("run_id"),
            F.col("r.execution_source").alias("execution_source"),
            F.col("r.status").alias("status"),
            F.col("r.dry_run").alias("dry_run"),
            started.alias("started_at_utc"),
            ended.alias("completed_at_utc"),
            duration.alias("duration_seconds"),
            F.col("r.failed_stage").alias("failed_stage"),
            F.col("r.error_message").alias("error_message"),
        ],
    )


def require_no_rejects(parsed: ParsedRuns) -> DataFrame:
    """The runs, or an error naming the first bad line."""
    first = parsed.rejects.orderBy(*parsed.rejects.columns[2:], "manifest_line_number").take(1)
    if first:
        line, reason, *file = first[0]
        raise ManifestError(": ".join([*file, f"line {line}", reason]))
    return parsed.runs


def _missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_ingestion_runs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Strict reader; an absent manifest is an error."""
    try:
        lines = numbered_lines(spark, paths)
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"no ingestion manifest at {paths}") from error
        raise
    return require_no_rejects(parse_ingestion_runs(lines))


def read_full_runs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Strict reader; an absent manifest means that nothing ran yet."""
    try:
        lines = numbered_lines(spark, paths)
    except AnalysisException as error:
        if _missing_path(error):
            return spark.createDataFrame([], FULL_RUN_SCHEMA)
        raise
    return require_no_rejects(parse_full_runs(lines))
