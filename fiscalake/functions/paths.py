"""Facts carried by the path of a snapshot file."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path fields of the Bronze layout.
MUNICIPALITY_PATTERN = "municipio=([^/]+)"
YEAR_PATTERN = "exercicio=([0-9]{4})"
MONTH_PATTERN = "mes=([0-9]{2})"

# A snapshot is one landed ``..._<stamp>.json`` array file, or a folder
# ``snapshot=<stamp>`` holding any number of part files.
_SNAPSHOT_FOLDER_PATTERN = "^(.*/snapshot=[^/]+)/[^/]+$"
_STAMP_PATTERN = "([0-9]{8}T[0-9]{6}Z)[^/]*$"


def _percent_decoded(text: Column) -> Column:
    """``%XX`` undone; a plus stays a plus, and text that is no such code stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def plain_path(uri: Column) -> Column:
    """The path as the file system spells it, from the URI in a file's metadata."""
    return _percent_decoded(uri)


def literal_path(path: str) -> str:
    """A path for a reader that takes patterns: every sign stands for itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def path_municipality(path: Column) -> Column:
    """The value as it was written: folder names hold some signs as ``%XX``."""
    return _percent_decoded(F.regexp_extract(path, MUNICIPALITY_PATTERN, 1))


def path_year_text(path: Column) -> Column:
    return F.regexp_extract(path, YEAR_PATTERN, 1)


def path_year(path: Column) -> Column:
    return path_year_text(path).try_cast("int")


def path_month(path: Column) -> Column:
    return F.regexp_extract(path, MONTH_PATTERN, 1).try_cast("int")


def in_snapshot_folder(path: Column) -> Column:
    return path.contains("/snapshot=")


def snapshot_name(path: Column) -> Column:
    folder = F.regexp_extract(path, _SNAPSHOT_FOLDER_PATTERN, 1)
    return F.when(in_snapshot_folder(path), folder).otherwise(path)


def snapshot_stamp(name: Column) -> Column:
    """UTC stamp ending the snapshot's name; its text order is time order."""
    return F.regexp_extract(name, _STAMP_PATTERN, 1)
