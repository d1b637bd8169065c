"""Data-quality rules: declared column tests, duplicates, partition consistency.

Row rules are predicates marking a failing row. All row rules of a table are counted
in one pass, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.paths import path_month, path_year
from fiscalake.sources.schemas import SOURCE_PATH

ERROR = "error"
WARNING = "warning"
INFORMATIONAL = "informational"

RESULT_COLUMNS = ("check", "column", "severity", "failures")


@dataclass(frozen=True)
class Rule:
    """A named predicate that is true for a failing row.

    The predicate is built on use: columns need a running session.
    """

    check: str
    column: str
    fails: Callable[[], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict[str, Sequence] = field(default_factory=dict)
    relationships: Sequence[Relationship] = ()
    rules: Sequence[Rule] = ()


def not_null(column: str, severity: str = ERROR, check: str = "not_null") -> Rule:
    return Rule(check, column, lambda: F.col(column).isNull(), severity)


def accepted_values(column: str, values: Iterable, severity: str = ERROR) -> Rule:
    """NULL is neither accepted nor rejected; that is what ``not_null`` is for."""
    accepted = list(values)
    return Rule("accepted_values", column, lambda: ~F.col(column).isin(accepted), severity)


def partition_mismatch() -> Column:
    """Typed year or month differs from the source path; NULL counts as a value."""
    path = F.col(SOURCE_PATH)
    same_year = F.col("exercicio").eqNullSafe(path_year(path))
    same_month = F.col("mes").eqNullSafe(path_month(path))
    return ~(same_year & same_month)


def _sql_text(text: str) -> str:
    """A SQL string literal; every sign of ``text`` stands for itself."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def check_rows(counted: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per (check, column, severity) from a one-row frame of counters r0, r1, ...

    Written as one SQL expression: building it column by column costs thousands of
    calls into the JVM when all tables are checked.
    """
    rows = ", ".join(
        f"struct({_sql_text(check)} as check, {_sql_text(column)} as column, "
        f"{_sql_text(severity)} as severity, cast(coalesce(r{i}, 0) as bigint) as failures)"
        for i, (check, column, severity) in enumerate(rules)
    )
    return counted.select(F.expr(f"inline(array({rows}))"))


def count_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its number of failing rows, from a single aggregate."""
    counted = df.agg(*[F.count_if(rule.fails()).alias(f"r{i}") for i, rule in enumerate(rules)])
    return check_rows(counted, [(r.check, r.column, r.severity) for r in rules])


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of all given columns from one scan and one shuffle, NULL left out.

    Values are counted on the map side, so a dominant one costs no more than a rare one.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def count_repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``unique`` checks: how many values of each column occur more than once."""
    repeated = F.col("n") > 1
    counted = _value_counts(df, columns).agg(
        *[F.count_if(repeated & (F.col("column") == c)).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    return check_rows(counted, [("unique", c, ERROR) for c in columns])


def count_orphans(
    df: DataFrame, tables: dict[str, DataFrame], relationships: Sequence[Relationship]
) -> DataFrame:
    """``relationships`` checks: rows of each foreign key without a parent.

    All keys of a table go through one scan and one join of distinct values. The join
    is an outer one with a NULL test: an anti join would be pushed below the counting
    and would then move every row instead of every distinct key.
    """
    parents = [
        tables[rel.parent].select(
            F.lit(rel.column).alias("column"),
            F.col(rel.parent_column).cast("string").alias("value"),
            F.lit(True).alias("known"),
        )
        for rel in relationships
    ]
    columns = [rel.column for rel in relationships]
    missing = (
        _value_counts(df, columns)
        .join(reduce(DataFrame.union, parents), ["column", "value"], "left")
        .where(F.col("known").isNull())
    )
    counted = missing.agg(
        *[F.sum(F.when(F.col("column") == c, F.col("n"))).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    return check_rows(counted, [("relationships", c, ERROR) for c in columns])


def duplicate_groups(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Groups of equal rows with their size; NULLs compare equal.

    Copies collapse on the map side before the one shuffle.
    """
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("quantidade")).where("quantidade > 1")
    )


def count_as_check(
    failing: DataFrame, check: str, column: str, severity: str = ERROR, total: Column | None = None
) -> DataFrame:
    """A check row from failing rows, or from a sum over them."""
    amount = F.count(F.lit(1)) if total is None else F.sum(total)
    return check_rows(failing.agg(amount.alias("r0")), [(check, column, severity)])


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL left out."""
    return duplicate_groups(df.where(F.col(column).isNotNull()), [column])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent, and how many child rows carry each.

    The child is reduced to its distinct keys before the join, so the join moves
    keys rather than rows and a dominant key costs no more than a rare one. See
    ``count_orphans`` for why it is an outer join.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("fk"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    known = parent.select(F.col(parent_column).alias("pk"))
    joined = keys.join(known, F.col("fk") == F.col("pk"), "left")
    return joined.where(F.col("pk").isNull()).select("fk", "child_rows")


def run_table_tests(name: str, tables: dict[str, DataFrame], tests: TableTests) -> DataFrame:
    """Every declared test of a table: (table, check, column, severity, failures).

    At most three passes: row rules, uniqueness, foreign keys.
    """
    df = tables[name]
    rules = [not_null(c) for c in tests.not_null]
    rules += [accepted_values(c, values) for c, values in tests.accepted.items()]
    rules += tests.rules
    parts = [count_failures(df, rules)] if rules else []
    if tests.unique:
        parts.append(count_repeated(df, tests.unique))
    if tests.relationships:
        parts.append(count_orphans(df, tables, tests.relationships))
    return reduce(DataFrame.union, parts).select(F.lit(name).alias("table"), *RESULT_COLUMNS)
