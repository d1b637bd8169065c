"""Silver against Gold: row counts and sums per group. No rows means agreement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_and_sum(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("quantidade"), F.sum(amount).alias("valor")
    )


def differences(silver: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups whose count or sum differs between two outputs of ``count_and_sum``.

    Keys are compared with plain equality: a NULL group pairs with nothing and is
    reported from both sides.
    """
    s, g = silver.alias("s"), gold.alias("g")
    same_key = [F.col(f"s.{k}") == F.col(f"g.{k}") for k in keys]
    agree = F.col("s.quantidade").eqNullSafe(F.col("g.quantidade")) & F.col("s.valor").eqNullSafe(
        F.col("g.valor")
    )
    return (
        s.join(g, same_key, "full_outer")
        .where(~agree)
        .select(
            *[F.coalesce(F.col(f"s.{k}"), F.col(f"g.{k}")).alias(k) for k in keys],
            F.col("s.quantidade").alias("quantidade_silver"),
            F.col("g.quantidade").alias("quantidade_gold"),
            F.col("s.valor").alias("valor_silver"),
            F.col("g.valor").alias("valor_gold"),
        )
    )


def reconcile_expenses(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Per event: amounts of different events are different things and never add up."""
    keys = ["evento"]
    return differences(
        count_and_sum(silver, keys, "vl_despesa"), count_and_sum(fact, keys, "vl_despesa"), keys
    )


def reconcile_revenues(silver: DataFrame, fact: DataFrame, municipality: DataFrame) -> DataFrame:
    """Per municipality, year and month.

    The fact is aggregated by its municipality key first, so the dimension is joined
    to groups and not to fact rows.
    """
    keys = ["municipio", "exercicio", "mes"]
    by_key = count_and_sum(fact, ["municipio_sk", "exercicio", "mes"], "vl_arrecadacao")
    gold = by_key.join(municipality.select("municipio_sk", "municipio"), "municipio_sk")
    return differences(
        count_and_sum(silver, keys, "vl_arrecadacao"),
        gold.select(*keys, "quantidade", "valor"),
        keys,
    )


#: Buckets of each level of the search for rows that differ, from coarse to fine.
BUCKETS = (1 << 10, 1 << 20)


def _hashed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The compared columns and two hashes of them; NULL is told from every value."""
    told = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return df.select(*columns).withColumns(
        {"_bucket": F.xxhash64(F.lit(1), *told), "_hash": F.xxhash64(F.lit(2), *told)}
    )


def _bucket_sums(hashed: DataFrame, buckets: int) -> DataFrame:
    """Rows and sum of hashes of each bucket: equal multisets of rows have equal sums.

    Sums are taken in halves, so that they cannot overflow; tasks add up their own rows.
    """
    return hashed.groupBy(F.pmod("_bucket", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftrightunsigned("_hash", 32)).alias("high"),
        F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )


def _differing(left: DataFrame, right: DataFrame, buckets: int) -> list[int]:
    """Buckets of which the sides disagree; at most ``buckets`` numbers."""
    sides = [
        df.select("bucket", *[(sign * F.col(c)).alias(c) for c in ("n", "high", "low")])
        for df, sign in ((_bucket_sums(left, buckets), 1), (_bucket_sums(right, buckets), -1))
    ]
    total = sides[0].unionByName(sides[1]).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
    return [r["bucket"] for r in total.where("n <> 0 or high <> 0 or low <> 0").select("bucket").collect()]


def row_differences(
    silver: DataFrame, gold: DataFrame, columns: Sequence[str], buckets: Sequence[int] = BUCKETS
) -> DataFrame:
    """Rows that the sides do not hold equally often, with how often each of them does.

    Counts and sums of groups miss errors that cancel out. Here every row goes into the hash
    sum of a bucket, and only buckets that differ are opened, into finer ones and at last
    into rows. Sides that agree cost one aggregation each. Every number of ``buckets`` divides
    the next.
    """
    left, right = _hashed(silver, columns), _hashed(gold, columns)
    for n in buckets:
        found = _differing(left, right, n)
        opened = F.pmod("_bucket", F.lit(n)).isin(found)
        left, right = left.where(opened), right.where(opened)
        if not found:
            break
    # summed with opposite columns; the names are the result's, so none can clash with a compared one
    names, zero = ("quantidade_silver", "quantidade_gold"), F.lit(0).cast("bigint")
    counted = [
        df.groupBy(*columns).agg(
            *[(F.count(F.lit(1)) if side == k else F.max(zero)).alias(name) for k, name in enumerate(names)]
        )
        for side, df in enumerate((left, right))
    ]
    return (
        counted[0]
        .unionByName(counted[1])
        .groupBy(*columns)
        .agg(*[F.sum(name).alias(name) for name in names])
        .where(F.col(names[0]) != F.col(names[1]))
    )


EXPENSE_ROW = (
    "exercicio", "mes", "evento", "nr_empenho", "dt_emissao_despesa", "vl_despesa", "id_fornecedor", "nm_fornecedor",
)
REVENUE_ROW = (
    "exercicio", "mes", "orgao", "ds_fonte_recurso", "ds_cd_aplicacao_fixo", "ds_alinea", "ds_subalinea", "vl_arrecadacao",
)


def expense_row_differences(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Expense rows of Silver and fact that differ in what both of them store."""
    return row_differences(silver, fact.withColumnRenamed("nm_fornecedor_origem", "nm_fornecedor"), EXPENSE_ROW)


def revenue_row_differences(silver: DataFrame, fact: DataFrame) -> DataFrame:
    return row_differences(silver, fact.withColumnRenamed("nm_orgao_origem", "orgao"), REVENUE_ROW)
