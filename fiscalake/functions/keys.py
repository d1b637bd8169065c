"""Deterministic business and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "||"

# Supplier types, each with the identifier prefix that marks it.
PERSON = "PESSOA FÍSICA"
SUPPLIER_PREFIXES = {
    "CNPJ": "CNPJ -",
    PERSON: "PESSOA FÍSICA -",
    "IDENTIFICAÇÃO ESPECIAL": "IDENTIFICAÇÃO ESPECIAL",
    "INSCRIÇÃO GENÉRICA": "INSCRIÇÃO GENÉRICA",
    "INTERNACIONAL": "INTERNACIONAL",
}
OTHER_SUPPLIER = "OUTRO"
SUPPLIER_TYPES = (*SUPPLIER_PREFIXES, OTHER_SUPPLIER)

# Key and hash prefix of the subclass dimension.
MISSING_MEMBER_KEY = "-1"
SUBCLASS_KEY_PREFIX = "SUBALINEA||"


def joined_key(*cols: Column) -> Column:
    """Text of all columns; NULL columns are left out, which the hashes rely on."""
    return F.concat_ws(KEY_SEPARATOR, *[c.cast("string") for c in cols])


def hash_key(*cols: Column) -> Column:
    """md5 of one column (NULL stays NULL) or of several joined columns."""
    if len(cols) == 1:
        return F.md5(cols[0])
    return F.md5(joined_key(*cols))


def supplier_type(supplier_id: Column) -> Column:
    case = None
    for name, prefix in SUPPLIER_PREFIXES.items():
        matches = supplier_id.startswith(prefix)
        case = F.when(matches, F.lit(name)) if case is None else case.when(matches, F.lit(name))
    return case.otherwise(F.lit(OTHER_SUPPLIER))


def supplier_key(supplier_id: Column, supplier_name: Column) -> Column:
    """Persons share identifiers, so their name is part of the key."""
    is_person = supplier_id.startswith(SUPPLIER_PREFIXES[PERSON])
    return F.when(is_person, joined_key(supplier_id, supplier_name)).otherwise(supplier_id)


def organisation_hash(municipality: Column, organisation: Column) -> Column:
    return hash_key(municipality, organisation)


def subclass_hash(subclass: Column) -> Column:
    return F.md5(F.concat(F.lit(SUBCLASS_KEY_PREFIX), subclass))


def or_missing_member(key: Column) -> Column:
    return F.coalesce(key, F.lit(MISSING_MEMBER_KEY))


def period_key(year: Column, month: Column) -> Column:
    return year * 100 + month
