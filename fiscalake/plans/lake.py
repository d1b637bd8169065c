"""Tables of the lakehouse and the full rebuild that fills them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from fiscalake.operators import dimensions as D
from fiscalake.operators.contracts import EXPENSE_CONTRACT, REVENUE_CONTRACT
from fiscalake.operators.facts import fct_expense, fct_revenue
from fiscalake.plans.silver import silver_expenses, silver_revenues
from fiscalake.session import open_writers, scratch_path
from fiscalake.sources.schemas import EXPENSES, REVENUES
from fiscalake.sources.snapshots import read_latest

SILVER_TABLES = ("stg_despesas", "stg_receitas")
GOLD_TABLES = (
    "dim_municipio",
    "dim_orgao",
    "dim_tempo",
    "dim_fornecedor",
    "dim_fonte_recurso",
    "dim_aplicacao",
    "dim_alinea",
    "dim_subalinea",
    "fct_despesas",
    "fct_receitas",
)

_KEYS = "municipio_sk string, orgao_sk string, tempo_sk int"

PARTITIONED_SCHEMAS = {
    **{
        contract.table: ", ".join(f"{c.name} {c.type}" for c in contract.columns)
        for contract in (EXPENSE_CONTRACT, REVENUE_CONTRACT)
    },
    "fct_despesas": (
        f"despesa_sk string, {_KEYS}, fornecedor_sk string, exercicio int, mes int, "
        "evento string, nr_empenho string, dt_emissao_despesa date, vl_despesa decimal(18,2), "
        "id_fornecedor string, nm_fornecedor_origem string"
    ),
    "fct_receitas": (
        f"receita_sk string, receita_fingerprint string, nr_ocorrencia bigint, {_KEYS}, "
        "fonte_recurso_sk string, aplicacao_sk string, alinea_sk string, subalinea_sk string, "
        "exercicio int, mes int, vl_arrecadacao decimal(18,2), nm_orgao_origem string, "
        "ds_fonte_recurso string, ds_cd_aplicacao_fixo string, ds_alinea string, "
        "ds_subalinea string"
    ),
}

# Few, evenly filled folders that most reports filter on. Snapshot files hold one
# month each, so tables that are not shuffled are written by year as they come. The rows
# of revenue occurrences leave a shuffle, after which every task has rows of all years.
YEAR_PARTITION = ("exercicio",)
SHUFFLED_TABLES = ("fct_receitas",)


def partitioning(table: str) -> tuple[str, ...]:
    return YEAR_PARTITION if table in PARTITIONED_SCHEMAS else ()


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A table in its declared column order; partition columns are not inferred."""
    if table not in PARTITIONED_SCHEMAS:
        return spark.read.parquet(path)
    names = [column.split()[0] for column in PARTITIONED_SCHEMAS[table].split(", ")]
    return spark.read.schema(PARTITIONED_SCHEMAS[table]).parquet(path).select(*names)


@dataclass(frozen=True)
class Lake:
    """Parquet tables below one root, ``<root>/<layer>/<table>``."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        layer = "silver" if table in SILVER_TABLES else "gold"
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def write(self, table: str, df: DataFrame) -> None:
        """Replace a table by a full rebuild.

        Rows that come from a shuffle are rebalanced by year first, else every task would
        open a file for every year; a large year is split over tasks.
        """
        years = partitioning(table)
        dealt = df.hint("rebalance", *years) if table in SHUFFLED_TABLES else df
        with open_writers(self.spark):
            dealt.write.mode("overwrite").partitionBy(*years).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, table, self.path(table))

    def tables(self, names: Sequence[str] = SILVER_TABLES + GOLD_TABLES) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names}


def _write_together(lake: Lake, models: dict[str, Callable[[], DataFrame]]) -> None:
    """Write independent models at the same time; small ones share the executors."""

    def write(item):
        name, model = item
        lake.write(name, model())

    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        list(pool.map(write, models.items()))


def write_silver(
    lake: Lake, expenses: Callable[[], DataFrame], revenues: Callable[[], DataFrame]
) -> None:
    _write_together(lake, {"stg_despesas": expenses, "stg_receitas": revenues})


def member_dimensions(members: DataFrame, as_of: date | None) -> dict[str, Callable[[], DataFrame]]:
    """The models of all dimensions that follow from stored ``distinct_members``."""
    of = {kind: D.members_of(members, kind) for kind in D.MEMBERS}
    nothing = {kind: of[kind].limit(0) for kind in ("place", "period")}
    return {
        "dim_municipio": lambda: D.dim_municipality(of["place"], nothing["place"]),
        "dim_orgao": lambda: D.dim_organisation(of["place"], nothing["place"]),
        "dim_tempo": lambda: D.dim_calendar(of["period"], nothing["period"], as_of),
        "dim_fonte_recurso": lambda: D.dim_source(of["source"]),
        "dim_aplicacao": lambda: D.dim_application(of["application"]),
        "dim_alinea": lambda: D.dim_class(of["class"]),
        "dim_subalinea": lambda: D.dim_subclass(of["subclass"]),
    }


def write_gold(lake: Lake, as_of: date | None = None) -> None:
    """Gold from the stored Silver, which facts, suppliers and members read once each.

    Seven dimensions then follow from the distinct members, which are few and stored.
    """
    expenses, revenues = lake.read("stg_despesas"), lake.read("stg_receitas")
    path = scratch_path(lake.spark, "members")

    def dimensions() -> None:
        found = D.distinct_members(expenses, revenues)
        found.write.parquet(path)
        _write_together(lake, member_dimensions(lake.spark.read.schema(found.schema).parquet(path), as_of))

    steps = (
        dimensions,
        lambda: lake.write("fct_receitas", fct_revenue(revenues)),
        lambda: lake.write("fct_despesas", fct_expense(expenses)),
        lambda: lake.write("dim_fornecedor", D.dim_supplier(expenses)),
    )
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        list(pool.map(lambda step: step(), steps))


def build(
    spark: SparkSession, bronze_root: str, lake_root: str, as_of: date | None = None
) -> Lake:
    """Rebuild Silver from the latest snapshots and Gold from Silver."""
    lake = Lake(spark, lake_root)
    write_silver(
        lake,
        lambda: silver_expenses(read_latest(spark, bronze_root, EXPENSES)),
        lambda: silver_revenues(read_latest(spark, bronze_root, REVENUES)),
    )
    write_gold(lake, as_of)
    return lake
