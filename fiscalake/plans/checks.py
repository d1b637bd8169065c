"""Declared tests of all Silver and Gold tables, plus the cross-table checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.keys import SUPPLIER_TYPES
from fiscalake.operators.contracts import EXPENSE_CONTRACT, MONTHS, REVENUE_CONTRACT
from fiscalake.operators.quality import (
    ERROR,
    RESULT_COLUMNS,
    WARNING,
    Relationship,
    Rule,
    TableTests,
    count_as_check,
    duplicate_groups,
    partition_mismatch,
    run_table_tests,
)
from fiscalake.operators.reconcile import reconcile_expenses, reconcile_revenues
from fiscalake.sources.schemas import EXPENSE_EVENTS, SOURCE_PATH

_MUNICIPALITY = Relationship("municipio_sk", "dim_municipio", "municipio_sk")
_ORGANISATION = Relationship("orgao_sk", "dim_orgao", "orgao_sk")
_CALENDAR = Relationship("tempo_sk", "dim_tempo", "tempo_sk")

_PATH_CONSISTENCY = Rule("partition_consistency", "mes", partition_mismatch)

_EXPENSE_TEXTS = ("orgao", "evento", "nr_empenho", "id_fornecedor", "nm_fornecedor")
_REVENUE_TEXTS = ("ds_fonte_recurso", "ds_cd_aplicacao_fixo", "ds_alinea")

# Which column is tested for what.
DECLARED_TESTS = {
    "stg_despesas": TableTests(
        not_null=(
            "municipio",
            "exercicio",
            "mes",
            *_EXPENSE_TEXTS,
            "dt_emissao_despesa",
            "vl_despesa",
            SOURCE_PATH,
        ),
        accepted={"mes": MONTHS, "evento": EXPENSE_EVENTS},
        rules=(_PATH_CONSISTENCY,),
    ),
    "stg_receitas": TableTests(
        not_null=(
            "municipio",
            "exercicio",
            "mes",
            "orgao",
            *_REVENUE_TEXTS,
            "vl_arrecadacao",
            SOURCE_PATH,
        ),
        accepted={"mes": MONTHS},
        rules=(_PATH_CONSISTENCY,),
    ),
    "dim_municipio": TableTests(
        not_null=("municipio_sk", "municipio", "nm_municipio", "uf"),
        unique=("municipio_sk", "municipio"),
    ),
    "dim_orgao": TableTests(
        not_null=("orgao_sk", "municipio_sk", "municipio", "nm_orgao"),
        unique=("orgao_sk",),
        relationships=(_MUNICIPALITY,),
    ),
    "dim_tempo": TableTests(
        not_null=(
            "tempo_sk",
            "dt_mes",
            "exercicio",
            "mes",
            "nm_mes",
            "trimestre",
            "semestre",
            "ano_mes",
        ),
        unique=("tempo_sk", "dt_mes", "ano_mes"),
        accepted={"mes": MONTHS, "trimestre": (1, 2, 3, 4), "semestre": (1, 2)},
    ),
    "dim_fornecedor": TableTests(
        not_null=(
            "fornecedor_sk",
            "fornecedor_bk",
            "id_fornecedor",
            "tipo_fornecedor",
            "nm_fornecedor_atual",
            "primeira_dt_observada",
            "ultima_dt_observada",
            "qtd_nomes_observados",
        ),
        unique=("fornecedor_sk", "fornecedor_bk"),
        accepted={"tipo_fornecedor": SUPPLIER_TYPES},
    ),
    "fct_despesas": TableTests(
        not_null=(
            "despesa_sk",
            "municipio_sk",
            "orgao_sk",
            "tempo_sk",
            "fornecedor_sk",
            "exercicio",
            "mes",
            "evento",
            "nr_empenho",
            "dt_emissao_despesa",
            "vl_despesa",
            "id_fornecedor",
            "nm_fornecedor_origem",
        ),
        unique=("despesa_sk",),
        accepted={"evento": EXPENSE_EVENTS},
        relationships=(
            _MUNICIPALITY,
            _ORGANISATION,
            _CALENDAR,
            Relationship("fornecedor_sk", "dim_fornecedor", "fornecedor_sk"),
        ),
    ),
    "fct_receitas": TableTests(
        not_null=(
            "receita_sk",
            "receita_fingerprint",
            "nr_ocorrencia",
            "municipio_sk",
            "orgao_sk",
            "tempo_sk",
            "fonte_recurso_sk",
            "aplicacao_sk",
            "alinea_sk",
            "subalinea_sk",
            "exercicio",
            "mes",
            "vl_arrecadacao",
            "nm_orgao_origem",
            *_REVENUE_TEXTS,
        ),
        unique=("receita_sk",),
        relationships=(
            _MUNICIPALITY,
            _ORGANISATION,
            _CALENDAR,
            Relationship("fonte_recurso_sk", "dim_fonte_recurso", "fonte_recurso_sk"),
            Relationship("aplicacao_sk", "dim_aplicacao", "aplicacao_sk"),
            Relationship("alinea_sk", "dim_alinea", "alinea_sk"),
            Relationship("subalinea_sk", "dim_subalinea", "subalinea_sk"),
        ),
    ),
}


def _as_result(check: DataFrame, table: str) -> DataFrame:
    return check.select(F.lit(table).alias("table"), *RESULT_COLUMNS)


def cross_checks(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Duplicates and reconciliation; duplicate revenues only warn."""
    expenses, revenues = tables["stg_despesas"], tables["stg_receitas"]
    expense_groups = duplicate_groups(expenses, list(EXPENSE_CONTRACT.duplicate_columns))
    revenue_groups = duplicate_groups(revenues, list(REVENUE_CONTRACT.duplicate_columns))
    expense_gap = reconcile_expenses(expenses, tables["fct_despesas"])
    revenue_gap = reconcile_revenues(revenues, tables["fct_receitas"], tables["dim_municipio"])
    found = [
        ("stg_despesas", expense_groups, "exact_duplicates", ERROR),
        ("stg_receitas", revenue_groups, "potential_exact_duplicates", WARNING),
        ("fct_despesas", expense_gap, "reconciles_with_silver", ERROR),
        ("fct_receitas", revenue_gap, "reconciles_with_silver", ERROR),
    ]
    return [
        _as_result(count_as_check(rows, check, "*", severity), table)
        for table, rows, check, severity in found
    ]


def run_all_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, check, column, severity, failures) for every declared and cross check."""
    parts = [run_table_tests(name, tables, tests) for name, tests in DECLARED_TESTS.items()]
    return reduce(DataFrame.union, [*parts, *cross_checks(tables)])


def failed_checks(results: DataFrame) -> DataFrame:
    """Checks that must stop a publication."""
    return results.where((F.col("severity") == ERROR) & (F.col("failures") > 0))
