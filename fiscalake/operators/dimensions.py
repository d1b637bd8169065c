"""Gold dimensions: one row per business key, hashed keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.keys import (
    MISSING_MEMBER_KEY,
    hash_key,
    organisation_hash,
    period_key,
    subclass_hash,
    supplier_key,
    supplier_type,
)
from fiscalake.functions.parse import month_name
from fiscalake.functions.text import code_part, description_part

# Display name and state of the municipalities known so far.
KNOWN_MUNICIPALITIES = {"salto": ("Salto", "SP")}

# Fixed value: text of the member standing for a missing subclass.
MISSING_MEMBER_TEXT = "Não informada"


def distinct_of_both(expenses: DataFrame, revenues: DataFrame, *columns: str) -> DataFrame:
    """Set union of both datasets; one shuffle, after map-side de-duplication."""
    return expenses.select(*columns).unionByName(revenues.select(*columns)).distinct()


#: Columns of the distinct members of each kind.
MEMBERS = {
    "place": ("municipio", "orgao"),
    "period": ("exercicio", "mes"),
    "source": ("ds_fonte_recurso",),
    "application": ("ds_cd_aplicacao_fixo",),
    "class": ("ds_alinea",),
    "subclass": ("ds_subalinea",),
}
_OF_BOTH = ("place", "period")


def distinct_members(expenses: DataFrame, revenues: DataFrame) -> DataFrame:
    """(kind, a, b): what all dimensions but the supplier's are made of, from one scan of each side.

    Each row gives a member of every kind; tasks keep the distinct ones, which are few, before
    the one shuffle.
    """

    def members(rows: DataFrame, kinds) -> DataFrame:
        each = []
        for kind in kinds:
            names = [F.col(c).cast("string") for c in MEMBERS[kind]]
            a, b = (names + [F.lit(None).cast("string")])[:2]
            each.append(F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b")))
        return rows.select(F.inline(F.array(*each)))

    return members(expenses, _OF_BOTH).unionByName(members(revenues, MEMBERS)).distinct()


def members_of(members: DataFrame, kind: str) -> DataFrame:
    """The members of a kind under the names that the dimensions read."""
    number = "int" if kind == "period" else "string"
    columns = [F.col(x).cast(number).alias(name) for x, name in zip("ab", MEMBERS[kind])]
    return members.where(F.col("kind") == kind).select(*columns)


def _known(field: int, otherwise: Column) -> Column:
    case = None
    for slug, values in KNOWN_MUNICIPALITIES.items():
        hit = F.col("municipio") == slug
        value = F.lit(values[field])
        case = F.when(hit, value) if case is None else case.when(hit, value)
    return case.otherwise(otherwise)


def dim_municipality(
    expenses: DataFrame, revenues: DataFrame, names: DataFrame | None = None
) -> DataFrame:
    """Municipalities with display name and state; those unknown keep their own text.

    ``names`` (municipio, nm_municipio, uf) is a table of any number of municipalities, one row
    each; its size decides how Spark joins it. Without it the fixed values above are used.
    """
    found = distinct_of_both(expenses, revenues, "municipio")
    if names is None:
        named = found.withColumns(
            {
                "nm_municipio": _known(0, F.col("municipio")),
                "uf": _known(1, F.lit(None).cast("string")),
            }
        )
    else:
        named = found.join(names.select("municipio", "nm_municipio", "uf"), "municipio", "left").withColumn(
            "nm_municipio", F.coalesce("nm_municipio", "municipio")
        )
    return named.select(
        hash_key(F.col("municipio")).alias("municipio_sk"), "municipio", "nm_municipio", "uf"
    )


def dim_organisation(expenses: DataFrame, revenues: DataFrame) -> DataFrame:
    return distinct_of_both(expenses, revenues, "municipio", "orgao").select(
        organisation_hash(F.col("municipio"), F.col("orgao")).alias("orgao_sk"),
        hash_key(F.col("municipio")).alias("municipio_sk"),
        "municipio",
        F.col("orgao").alias("nm_orgao"),
    )


def month_series(limits: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per month from start to end; none when a bound is missing or reversed."""
    step = F.expr("interval 1 month")
    ordered = F.col(start) <= F.col(end)
    months = F.when(ordered, F.sequence(F.col(start), F.col(end), step))
    return limits.select(F.explode(months).alias(out))


def dim_calendar(
    expenses: DataFrame, revenues: DataFrame, as_of: date | Column | None = None
) -> DataFrame:
    """Gap-free months from the first one seen to the month of ``as_of`` (today)."""
    if as_of is None:
        last_day = F.current_date()
    elif isinstance(as_of, Column):
        last_day = as_of
    else:
        last_day = F.lit(as_of)
    periods = expenses.select("exercicio", "mes").unionByName(revenues.select("exercicio", "mes"))
    limits = periods.agg(
        F.min(F.make_date(F.col("exercicio"), F.col("mes"), F.lit(1))).alias("first_month")
    ).withColumn("last_month", F.trunc(last_day, "MM"))
    year = F.year("dt_mes").cast("bigint")
    month = F.month("dt_mes").cast("bigint")
    return month_series(limits, "first_month", "last_month", "dt_mes").select(
        period_key(year, month).alias("tempo_sk"),
        "dt_mes",
        year.alias("exercicio"),
        month.alias("mes"),
        month_name(month).alias("nm_mes"),
        F.quarter("dt_mes").alias("trimestre"),
        F.when(month <= 6, F.lit(1)).otherwise(F.lit(2)).alias("semestre"),
        F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0")).alias(
            "ano_mes"
        ),
    )


def with_supplier_key(expenses: DataFrame) -> DataFrame:
    return expenses.withColumn(
        "fornecedor_bk", supplier_key(F.col("id_fornecedor"), F.col("nm_fornecedor"))
    )


def supplier_occurrences(expenses: DataFrame, *origin: str) -> DataFrame:
    """How often each name of a supplier was seen on each date, in each ``origin`` if given.

    Counts of several origins add up, so they can be kept apart, replaced and taken back.
    """
    return (
        with_supplier_key(expenses)
        .where(F.col("fornecedor_bk").isNotNull())
        .groupBy(*origin, "fornecedor_bk", "id_fornecedor", "nm_fornecedor", "dt_emissao_despesa")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged_occurrences(occurrences: DataFrame) -> DataFrame:
    """Occurrences of several origins as those of one."""
    keys = ("fornecedor_bk", "id_fornecedor", "nm_fornecedor", "dt_emissao_despesa")
    return occurrences.groupBy(*keys).agg(F.sum("n").alias("n"))


def dim_supplier(expenses: DataFrame) -> DataFrame:
    """Suppliers with their current name: latest date, then most rows, then name."""
    return suppliers_of(supplier_occurrences(expenses))


def suppliers_of(occurrences: DataFrame) -> DataFrame:
    """The supplier dimension from counted occurrences.

    Three aggregations, with the one that counts, each with map-side combining and each over
    the shrunken output of the one before, so a supplier holding a large share of all rows is
    never brought into one task as rows. The first row by rank is the minimum of
    an ordering struct, which needs neither a window nor a join back.
    """
    date_seen = F.col("dt_emissao_despesa")
    latest_first = F.struct(
        date_seen.isNull().alias("undated"),
        (-F.unix_date(date_seen)).alias("age"),
        (-F.col("n")).alias("rarity"),
    )
    names = occurrences.groupBy("fornecedor_bk", "id_fornecedor", "nm_fornecedor").agg(
        F.min(latest_first).alias("rank"),
        F.min(date_seen).alias("first_seen"),
        F.max(date_seen).alias("last_seen"),
    )
    current_first = F.struct(
        F.col("rank"),
        F.col("nm_fornecedor").isNull().alias("unnamed"),
        F.col("nm_fornecedor"),
        F.col("id_fornecedor"),
    )
    return (
        names.groupBy("fornecedor_bk")
        .agg(
            F.min(current_first).alias("current"),
            F.min("first_seen").alias("primeira_dt_observada"),
            F.max("last_seen").alias("ultima_dt_observada"),
            # Within one key every (identifier, name) pair has its own name, so the
            # rows of this level count distinct names without a further shuffle.
            F.count("nm_fornecedor").alias("qtd_nomes_observados"),
        )
        .select(
            hash_key(F.col("fornecedor_bk")).alias("fornecedor_sk"),
            "fornecedor_bk",
            F.col("current.id_fornecedor").alias("id_fornecedor"),
            supplier_type(F.col("current.id_fornecedor")).alias("tipo_fornecedor"),
            F.col("current.nm_fornecedor").alias("nm_fornecedor_atual"),
            "primeira_dt_observada",
            "ultima_dt_observada",
            "qtd_nomes_observados",
        )
    )


def _split_members(values: DataFrame, text: str, key: Column, suffix: str) -> DataFrame:
    return values.select(
        key.alias(f"{suffix}_sk"),
        code_part(F.col(text)).alias(f"cd_{suffix}"),
        description_part(F.col(text)).alias(f"nm_{suffix}"),
        text,
    )


def _code_dimension(revenues: DataFrame, text: str, suffix: str) -> DataFrame:
    """Distinct ``code - description`` texts; a NULL text stays as a NULL-keyed row."""
    return _split_members(revenues.select(text).distinct(), text, hash_key(F.col(text)), suffix)


def dim_source(revenues: DataFrame) -> DataFrame:
    return _code_dimension(revenues, "ds_fonte_recurso", "fonte_recurso")


def dim_application(revenues: DataFrame) -> DataFrame:
    return _code_dimension(revenues, "ds_cd_aplicacao_fixo", "aplicacao")


def dim_class(revenues: DataFrame) -> DataFrame:
    return _code_dimension(revenues, "ds_alinea", "alinea")


def dim_subclass(revenues: DataFrame) -> DataFrame:
    """As the other code dimensions, without NULLs, plus the missing-value member."""
    text = F.col("ds_subalinea")
    values = revenues.select(text).where(text.isNotNull()).distinct()
    members = _split_members(values, "ds_subalinea", subclass_hash(text), "subalinea").withColumn(
        "is_nao_informada", F.lit(False)
    )
    missing = revenues.sparkSession.range(0, 1, 1, 1).select(
        F.lit(MISSING_MEMBER_KEY).alias("subalinea_sk"),
        F.lit(None).cast("string").alias("cd_subalinea"),
        F.lit(MISSING_MEMBER_TEXT).alias("nm_subalinea"),
        F.lit(MISSING_MEMBER_TEXT).alias("ds_subalinea"),
        F.lit(True).alias("is_nao_informada"),
    )
    return members.unionByName(missing)
