"""Every planted defect is found, with its exact count."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_gold import EXPENSE, REVENUE, expense_row, revenue_row

from fiscalake.operators import contracts, quality
from fiscalake.operators.quality import Relationship, TableTests
from fiscalake.plans import checks
from fiscalake.plans.lake import Lake, write_gold, write_silver

PATH = "despesas/municipio=salto/exercicio=2021/mes=01/a_20210101T000000Z.json"


def failures(df):
    return {(r.check, r.column): r.failures for r in df.collect()}


def test_row_rules_in_one_pass(spark):
    rows = [
        expense_row(arquivo_origem=PATH),
        expense_row(arquivo_origem=PATH, mes=None, orgao=None),
        expense_row(arquivo_origem=PATH, mes=13, evento="Outro"),
        expense_row(arquivo_origem=PATH, exercicio=2020),
    ]
    df = spark.createDataFrame(rows, EXPENSE)
    rules = [
        quality.not_null("mes"),
        quality.not_null("orgao"),
        quality.not_null("evento"),
        quality.accepted_values("mes", contracts.MONTHS),
        quality.accepted_values("evento", contracts.EXPENSE_EVENTS),
        quality.Rule("path", "mes", quality.partition_mismatch),
    ]
    assert failures(quality.count_failures(df, rules)) == {
        ("not_null", "mes"): 1,
        ("not_null", "orgao"): 1,
        ("not_null", "evento"): 0,
        ("accepted_values", "mes"): 1,
        ("accepted_values", "evento"): 1,
        ("path", "mes"): 3,
    }


def test_unique_and_relationships(spark):
    child = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "x"), (2, "x"), (None, None)], "id int, fk string"
    )
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "pk string")
    tests = TableTests(unique=("id", "fk"), relationships=(Relationship("fk", "parent", "pk"),))
    got = quality.run_table_tests("child", {"child": child, "parent": parent}, tests)
    assert failures(got) == {
        ("unique", "id"): 1,
        ("unique", "fk"): 1,
        ("relationships", "fk"): 2,
    }
    assert {tuple(r) for r in quality.repeated_values(child, "id").collect()} == {(2, 3)}
    assert {tuple(r) for r in quality.orphans(child, "fk", parent, "pk").collect()} == {("x", 2)}


def test_checks_of_an_empty_table_report_zero(spark):
    empty = spark.createDataFrame([], "id int, fk string")
    tests = TableTests(
        not_null=("id",), unique=("id",), relationships=(Relationship("fk", "empty", "fk"),)
    )
    got = failures(quality.run_table_tests("empty", {"empty": empty}, tests))
    assert got == {("not_null", "id"): 0, ("unique", "id"): 0, ("relationships", "fk"): 0}


def test_the_key_join_does_not_move_rows(spark):
    """Keys are counted before they meet their parents."""
    child = spark.range(1000).select((F.col("id") % 3).cast("string").alias("fk"))
    parent = spark.range(5).select(F.col("id").cast("string").alias("pk"))
    plan = quality.orphans(child, "fk", parent, "pk")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate") < plan.index("Range (0, 1000")


def test_duplicates(spark):
    rows = [expense_row()] * 3 + [expense_row(arquivo_origem="f2", nm_fornecedor=None)] * 2
    df = spark.createDataFrame([*rows, expense_row(nr_empenho="2")], EXPENSE)
    groups = quality.duplicate_groups(df, list(contracts.EXPENSE_CONTRACT.duplicate_columns))
    assert sorted(r.quantidade for r in groups.collect()) == [2, 3]


def test_contract_accepts_silver_and_finds_defects(spark):
    good = spark.createDataFrame([expense_row(arquivo_origem=PATH)], EXPENSE)
    clean = contracts.check_contract(good, contracts.EXPENSE_CONTRACT)
    assert {v for v in failures(clean).values()} == {0}

    bad = spark.createDataFrame(
        [
            expense_row(arquivo_origem=PATH, vl_despesa=None, dt_emissao_despesa=None),
            *[expense_row(arquivo_origem=PATH, evento="Outro")] * 2,
        ],
        EXPENSE,
    )
    changed = bad.withColumn("mes", F.col("mes").cast("string")).drop("orgao").withColumn("x", F.lit(1))
    found = failures(contracts.check_contract(bad, contracts.EXPENSE_CONTRACT))
    assert found[("valid_expense_value", "vl_despesa")] == 1
    assert found[("valid_issue_date", "dt_emissao_despesa")] == 1
    assert found[("valid_event", "evento")] == 2
    assert found[("accepted_values", "evento")] == 2
    assert found[("exact_duplicates", "*")] == 1
    schema = failures(contracts.check_contract(changed, contracts.EXPENSE_CONTRACT))
    assert schema[("column_present", "orgao")] == 1
    assert schema[("column_type", "mes")] == 1
    assert schema[("column_unexpected", "x")] == 1


def test_revenue_contract_only_warns_about_duplicates(spark):
    path = PATH.replace("despesas", "receitas").replace("mes=01", "mes=02")
    rows = [revenue_row(arquivo_origem=path)] * 2 + [revenue_row(arquivo_origem=path, ds_subalinea=None)]
    checked = contracts.check_contract(
        spark.createDataFrame(rows, REVENUE), contracts.REVENUE_CONTRACT
    ).collect()
    found = {r.check: (r.severity, r.failures) for r in checked if r.failures}
    assert found == {
        "potential_exact_duplicates": ("warning", 1),
        "optional_subalinea": ("informational", 1),
    }


def test_declared_tests_are_complete():
    tests = checks.DECLARED_TESTS.values()
    counts = [
        sum(len(t.not_null) for t in tests),
        sum(len(t.unique) for t in tests),
        sum(len(t.accepted) for t in tests),
        sum(len(t.relationships) for t in tests),
    ]
    assert counts == [74, 10, 8, 12]


@pytest.fixture
def built(spark, tmp_path):
    def make(expenses, revenues):
        lake = Lake(spark, str(tmp_path / "lake"))
        exp = spark.createDataFrame(expenses, EXPENSE)
        rev = spark.createDataFrame(revenues, REVENUE)
        write_silver(lake, lambda: exp, lambda: rev)
        write_gold(lake, date(2021, 12, 31))
        return lake

    return make


REVENUE_PATH = "receitas/municipio=salto/exercicio=2021/mes=02/a_20210101T000000Z.json"


def failing(lake):
    found = checks.failed_checks(checks.run_all_checks(lake.tables())).collect()
    return {(r.table, r.check, r.column): r.failures for r in found}


def test_all_checks_pass_on_clean_data(built):
    lake = built(
        [expense_row(arquivo_origem=PATH), expense_row(arquivo_origem=PATH, nr_empenho="2")],
        [revenue_row(arquivo_origem=REVENUE_PATH)] * 3,
    )
    assert failing(lake) == {}
    assert lake.read("fct_despesas").columns[5:7] == ["exercicio", "mes"]
    everything = checks.run_all_checks(lake.tables())
    assert everything.count() == 110
    warned = everything.where("failures > 0").collect()
    assert [(r.check, r.severity) for r in warned] == [("potential_exact_duplicates", "warning")]


def test_all_checks_find_planted_defects(built):
    lake = built(
        [
            expense_row(arquivo_origem=PATH),
            expense_row(arquivo_origem=PATH),
            expense_row(arquivo_origem=PATH, nr_empenho="3", id_fornecedor=None),
            expense_row(arquivo_origem=PATH, nr_empenho="4", mes=2, vl_despesa=None),
        ],
        [revenue_row(arquivo_origem=REVENUE_PATH, vl_arrecadacao=Decimal("1.00"), orgao=None)],
    )
    found = failing(lake)
    assert found[("stg_despesas", "exact_duplicates", "*")] == 1
    assert found[("stg_despesas", "not_null", "id_fornecedor")] == 1
    assert found[("stg_despesas", "partition_consistency", "mes")] == 1
    assert found[("fct_despesas", "unique", "despesa_sk")] == 1
    assert found[("fct_despesas", "reconciles_with_silver", "*")] == 1
    assert found[("fct_receitas", "reconciles_with_silver", "*")] == 1
    assert found[("dim_orgao", "not_null", "nm_orgao")] == 1
