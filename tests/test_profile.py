import pytest
from conftest import expense, revenue
from pyspark.errors import PySparkException

from fiscalake.operators import profile
from fiscalake.sources import snapshots
from fiscalake.sources.schemas import BRONZE_COLUMNS, EXPENSES, REVENUES


def metrics(df):
    return {(r.metric, r.column): r.value for r in df.collect()}


def test_expense_profile(spark, land_file):
    land_file(
        EXPENSES,
        2021,
        1,
        "20210101T000000Z",
        [
            expense(),
            expense(),
            expense(
                orgao=" ", mes="Março", evento="Outro evento", id_fornecedor=None,
                dt_emissao_despesa="30/02/2021", vl_despesa="abc",
            ),
        ],
    )
    bronze = snapshots.read_latest(spark, land_file.root, EXPENSES)
    got = metrics(profile.quality_profile(bronze, EXPENSES))
    blank = {c: 0 for c in BRONZE_COLUMNS[EXPENSES]} | {"orgao": 1, "id_fornecedor": 1}
    assert got == {
        ("total_records", None): 3,
        ("invalid_months", "mes"): 0,
        ("partition_month_mismatches", "mes"): 1,
        ("invalid_monetary_values", "vl_despesa"): 1,
        ("invalid_dates", "dt_emissao_despesa"): 1,
        ("exact_duplicate_groups", None): 1,
        ("exact_duplicate_excess_rows", None): 1,
        **{("null_or_empty", c): n for c, n in blank.items()},
    }
    values = profile.distinct_values(bronze, EXPENSES).orderBy("column", "value").collect()
    assert [tuple(r) for r in values] == [
        ("evento", "Empenhado"),
        ("evento", "Outro evento"),
        ("mes", "Janeiro"),
        ("mes", "Março"),
    ]


def test_revenue_profile(spark, land_file):
    land_file(
        REVENUES,
        2021,
        2,
        "20210201T000000Z",
        [
            revenue(),
            revenue(mes="Fevereirinho", ds_fonte_recurso="", ds_subalinea=None, vl_arrecadacao="xyz"),
        ],
    )
    bronze = snapshots.read_latest(spark, land_file.root, REVENUES)
    got = metrics(profile.quality_profile(bronze, REVENUES))
    assert got[("invalid_months", "mes")] == 1
    assert got[("partition_month_mismatches", "mes")] == 1
    assert got[("invalid_monetary_values", "vl_arrecadacao")] == 1
    assert got[("exact_duplicate_groups", None)] == 0
    assert got[("null_or_empty", "ds_fonte_recurso")] == 1
    assert got[("null_or_empty", "ds_subalinea")] == 1
    assert not any(metric == "invalid_dates" for metric, _ in got)


def test_duplicates_need_the_same_year(spark, land_file):
    """Equal records of two municipalities pair up unless told apart."""
    land_file(REVENUES, 2020, 2, "20210201T000000Z", [revenue()])
    land_file(REVENUES, 2021, 2, "20210201T000000Z", [revenue()])
    bronze = snapshots.read_latest(spark, land_file.root, REVENUES)
    assert profile.duplicate_contents(bronze, REVENUES).count() == 0
    land_file(REVENUES, 2021, 2, "20210201T000000Z", [revenue()], "itu")
    bronze = snapshots.read_latest(spark, land_file.root, REVENUES)
    assert profile.duplicate_contents(bronze, REVENUES).count() == 1
    assert profile.duplicate_contents(bronze, REVENUES, with_municipality=True).count() == 0


def test_unknown_dataset(spark):
    with pytest.raises(ValueError):
        profile.quality_profile(spark.range(1), "balancos")
    with pytest.raises(ValueError):
        profile.profile_dataset_schema(spark, "x", "balancos")


def test_schema_profile(spark, land_file):
    drifted = land_file(EXPENSES, 2021, 1, "20210101T000000Z", [{"b": 1, "a": 2}, {"a": 1, "b": 2, "c": 3}])
    empty = land_file(EXPENSES, 2021, 2, "20210201T000000Z", [])
    found = profile.profile_dataset_schema(spark, land_file.root, EXPENSES)
    assert {tuple(r) for r in found["schemas"].collect()} == {("a,b", 1, 1), ("a,b,c", 1, 1)}
    assert found["files"].count() == 2
    assert [r.path.rsplit("/", 1)[1] for r in found["empty_files"].collect()] == [empty.name]
    files = {(r.schema_keys, r.file.rsplit("/", 1)[1]) for r in found["schema_files"].collect()}
    assert files == {("a,b", drifted.name), ("a,b,c", drifted.name)}


@pytest.mark.parametrize("body", ['{"a": 1}', "[1]", '[{"a": 1}, [2]]'])
def test_schema_profile_rejects_other_shapes(spark, land_file, body):
    land_file(EXPENSES, 2021, 1, "20210101T000000Z", body)
    found = profile.profile_dataset_schema(spark, land_file.root, EXPENSES)
    with pytest.raises(PySparkException):
        found["schemas"].collect()
