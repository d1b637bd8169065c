"""Conversions that yield NULL for bad input instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalake.functions.text import strip_separators, trim_spaces

# Month names as the source writes them, in calendar order.
MONTH_NAMES = (
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
)

MONEY_TYPE = "decimal(18,2)"

ASCII_WHITESPACE = " \t\n\x0b\x0c\r"


def exact_month_number(col: Column) -> Column:
    """Month number of an untrimmed name; NULL when the text is not exactly a name.

    A constant map evaluates its argument once, unlike a chain of comparisons.
    """
    pairs = [F.lit(v) for n, name in enumerate(MONTH_NAMES, start=1) for v in (name, n)]
    return F.try_element_at(F.create_map(*pairs), col)


def month_number(col: Column) -> Column:
    return exact_month_number(strip_separators(col))


def month_name(col: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in MONTH_NAMES]), col.cast("int"))


def br_decimal(col: Column) -> Column:
    """``1.234,56`` to DECIMAL(18,2): dots dropped, comma becomes the decimal point."""
    plain = F.replace(trim_spaces(col), F.lit("."), F.lit(""))
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast(MONEY_TYPE)


def br_date(col: Column) -> Column:
    """``DD/MM/YYYY`` to DATE; one-digit day and month are accepted.

    Surrounding ASCII whitespace is ignored. Years must have four digits.
    """
    text = F.btrim(col, F.lit(ASCII_WHITESPACE))
    shaped = F.when(text.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), text)
    return F.try_to_date(shaped, "d/M/yyyy")


def iso_timestamp(col: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; without ``Z`` or an offset it is UTC, blank is NULL."""
    text = F.nullif(col, F.lit(""))
    zoned = (
        F.when(text.rlike(r"^[0-9-]+$"), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(r"[0-9]{2}:[0-9]{2}(:[0-9.]+)?$") & ~text.rlike(r"[+-][0-9]{2}:[0-9]{2}$"), F.concat(text, F.lit("Z")))
        .otherwise(text)
    )
    return zoned.try_cast("timestamp")


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def seconds_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(1e6)
