"""Text cleaning: trimming, blanks and ``code - description`` fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs). Tabs and line breaks
# are not part of the category and are kept.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)

# Separator of code and description, and the leading part to drop.
CODE_SEPARATOR = " - "
CODE_PREFIX_PATTERN = "^[^-]+ - "


def strip_separators(col: Column) -> Column:
    """Strip every Unicode space separator from both ends."""
    return F.btrim(col, F.lit(SPACE_SEPARATORS))


def trim_spaces(col: Column) -> Column:
    """As ``strip_separators``, fast for ASCII; meant for plain columns.

    Text of as many bytes as characters is ASCII, where U+0020 is the only separator
    and the plain trim, several times faster, does the same. The argument is
    evaluated more than once.
    """
    is_ascii = F.length(col) == F.octet_length(col)
    return F.when(is_ascii, F.trim(col)).otherwise(strip_separators(col))


def is_blank(col: Column) -> Column:
    return col.isNull() | (trim_spaces(col) == "")


def is_filled(col: Column) -> Column:
    return col.isNotNull() & (trim_spaces(col) != "")


def blank_to_null(col: Column) -> Column:
    return F.nullif(trim_spaces(col), F.lit(""))


def code_part(col: Column) -> Column:
    """Text before the first separator; the whole text when there is none."""
    return blank_to_null(F.split_part(col, F.lit(CODE_SEPARATOR), F.lit(1)))


def description_part(col: Column) -> Column:
    """Text after the code; later hyphens stay part of it."""
    return blank_to_null(F.regexp_replace(col, CODE_PREFIX_PATTERN, ""))
