"""Declared schemas. Nothing is inferred, so dates and money stay untouched text."""

from __future__ import annotations

from pyspark.sql import types as T

EXPENSES = "despesas"
REVENUES = "receitas"

# Bronze columns of both datasets, all of them text.
BRONZE_COLUMNS = {
    EXPENSES: (
        "orgao",
        "mes",
        "evento",
        "nr_empenho",
        "id_fornecedor",
        "nm_fornecedor",
        "dt_emissao_despesa",
        "vl_despesa",
    ),
    REVENUES: (
        "orgao",
        "mes",
        "ds_fonte_recurso",
        "ds_cd_aplicacao_fixo",
        "ds_alinea",
        "ds_subalinea",
        "vl_arrecadacao",
    ),
}
SOURCE_PATH = "arquivo_origem"
MONEY_COLUMN = {EXPENSES: "vl_despesa", REVENUES: "vl_arrecadacao"}

# The events an expense row may carry.
EXPENSE_EVENTS = ("Anulação", "Empenhado", "Reforço", "Valor Liquidado", "Valor Pago")


def known_dataset(dataset: str) -> str:
    if dataset not in BRONZE_COLUMNS:
        raise ValueError(f"unknown dataset {dataset!r}, expected one of {sorted(BRONZE_COLUMNS)}")
    return dataset


def bronze_schema(dataset: str) -> T.StructType:
    columns = BRONZE_COLUMNS[known_dataset(dataset)]
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
