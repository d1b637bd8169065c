"""Silver: typed rows, one for every source row. Both plans are shuffle-free."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.parse import br_date, br_decimal, month_number
from fiscalake.functions.paths import path_municipality, path_year
from fiscalake.functions.text import blank_to_null, strip_separators, trim_spaces
from fiscalake.sources.schemas import SOURCE_PATH


def _partition_columns():
    path = F.col(SOURCE_PATH)
    return [
        strip_separators(path_municipality(path)).alias("municipio"),
        path_year(path).alias("exercicio"),
        month_number(F.col("mes")).alias("mes"),
    ]


def _trimmed(*names: str):
    return [trim_spaces(F.col(name)).alias(name) for name in names]


def silver_expenses(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_partition_columns(),
        *_trimmed("orgao", "evento", "nr_empenho", "id_fornecedor", "nm_fornecedor"),
        br_date(strip_separators(F.col("dt_emissao_despesa"))).alias("dt_emissao_despesa"),
        br_decimal(F.col("vl_despesa")).alias("vl_despesa"),
        SOURCE_PATH,
    )


def silver_revenues(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        *_partition_columns(),
        *_trimmed("orgao", "ds_fonte_recurso", "ds_cd_aplicacao_fixo", "ds_alinea"),
        blank_to_null(F.col("ds_subalinea")).alias("ds_subalinea"),
        br_decimal(F.col("vl_arrecadacao")).alias("vl_arrecadacao"),
        SOURCE_PATH,
    )
