"""Executive indicators over the star schema.

Expense sums always fix one event: a commitment, its liquidation and its payment
describe the same money. ``Valor Pago`` is the default, money that left.

* revenue: sum of collected amounts
* expense: sum of the amounts of the chosen event
* balance: revenue minus expense; the running balance adds up a municipality's year
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAID = "Valor Pago"


def event_totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Count and sum of expense amounts per event and further keys."""
    return fact.groupBy("evento", *keys).agg(
        F.count(F.lit(1)).alias("lancamentos"), F.sum("vl_despesa").alias("valor")
    )


def monthly_balance(
    expenses: DataFrame, revenues: DataFrame, municipality: DataFrame, event: str = PAID
) -> DataFrame:
    """Revenue, expense, balance and running balance per municipality and month.

    Both facts are summed in one aggregation, so a month known to one side only
    needs no outer join.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    keys = ("municipio_sk", "exercicio", "mes")
    amounts = (
        revenues.select(*keys, F.col("vl_arrecadacao").alias("receita"), zero.alias("despesa"))
    ).unionByName(
        expenses.where(F.col("evento") == event).select(
            *keys, zero.alias("receita"), F.col("vl_despesa").alias("despesa")
        )
    )
    months = (
        amounts.groupBy(*keys)
        .agg(
            F.coalesce(F.sum("receita"), zero).alias("receita"),
            F.coalesce(F.sum("despesa"), zero).alias("despesa"),
        )
        .withColumn("saldo", F.col("receita") - F.col("despesa"))
    )
    to_date = (
        Window.partitionBy("municipio_sk", "exercicio")
        .orderBy("mes")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        months.withColumn("saldo_acumulado", F.sum("saldo").over(to_date))
        .join(municipality.select("municipio_sk", "municipio"), "municipio_sk")
        .select("municipio", "exercicio", "mes", "receita", "despesa", "saldo", "saldo_acumulado")
    )


def expense_by_organisation(
    expenses: DataFrame, organisation: DataFrame, event: str = PAID
) -> DataFrame:
    """Expense of one event per organisation; names join after the aggregation."""
    totals = event_totals(expenses.where(F.col("evento") == event), "orgao_sk")
    return totals.join(organisation, "orgao_sk").select(
        "municipio", "nm_orgao", "lancamentos", "valor"
    )


def expense_by_supplier(expenses: DataFrame, supplier: DataFrame, event: str = PAID) -> DataFrame:
    totals = event_totals(expenses.where(F.col("evento") == event), "fornecedor_sk")
    return totals.join(supplier, "fornecedor_sk").select(
        "fornecedor_bk", "nm_fornecedor_atual", "tipo_fornecedor", "lancamentos", "valor"
    )


def revenue_by_source(revenues: DataFrame, source: DataFrame) -> DataFrame:
    totals = revenues.groupBy("fonte_recurso_sk", "exercicio").agg(
        F.count(F.lit(1)).alias("lancamentos"), F.sum("vl_arrecadacao").alias("valor")
    )
    return totals.join(source, "fonte_recurso_sk").select(
        "cd_fonte_recurso", "nm_fonte_recurso", "exercicio", "lancamentos", "valor"
    )
