from datetime import date

import pytest
from conftest import expense
from pyspark.sql import functions as F
from test_gold import EXPENSE, expense_row

from fiscalake.operators import facts as FC
from fiscalake.operators import indicators, reconcile
from fiscalake.operators import dimensions as D
from fiscalake.plans import catalog, months, versions
from fiscalake.plans.publish import PublishError
from fiscalake.sources import landing
from fiscalake.sources.schemas import EXPENSES
from fiscalake.streaming import refresh


def silver(spark, *changes):
    rows = [expense_row(**c) for c in changes]
    names = [c.split()[0] for c in EXPENSE.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], EXPENSE)


def fact(spark, *changes):
    return FC.fct_expense(silver(spark, *changes))


def folders(spark, root, version):
    rows = versions.listed_parts(spark, root).where(F.col("version") == version).collect()
    return {(r.table, r.part): r.folder for r in rows}


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_only_changed_years_are_written(spark, tmp_path):
    root = str(tmp_path / "serving")
    base = [dict(exercicio=y, nr_empenho=str(k)) for y in (2020, 2021, 2022) for k in range(3)]
    dim = spark.createDataFrame([(1, "a")], "id int, name string")
    old = fact(spark, *base)
    one = versions.publish_version(spark, {"fct_despesas": old, "dim": dim}, root)
    new = fact(spark, *[{**c, "evento": "Anulação"} if c["exercicio"] == 2021 else c for c in base if c["exercicio"] != 2022])
    two = versions.publish_version(spark, {"fct_despesas": new, "dim": dim}, root)
    first, second = folders(spark, root, one), folders(spark, root, two)
    assert second["fct_despesas", "2020"] == first["fct_despesas", "2020"] and second["dim", "all"] == first["dim", "all"]
    assert second["fct_despesas", "2021"] != first["fct_despesas", "2021"]
    assert ("fct_despesas", "2022") not in second
    written = {p.name for p in (tmp_path / "serving" / "files" / two).rglob("_part=*")}
    assert written == {"_part=2021"}
    assert rows_of(versions.read_version(spark, root, "fct_despesas", one)) == rows_of(old)
    assert rows_of(versions.read_version(spark, root, "fct_despesas")) == rows_of(new)

    gone = versions.retain(spark, root, 1)
    assert {g.rsplit("=", 1)[1] for g in gone} == {"2021", "2022"}
    assert versions.versions(spark, root) == [two]
    assert rows_of(versions.read_version(spark, root, "fct_despesas")) == rows_of(new)
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root, "fct_despesas", one)


def test_empty_tables_and_short_copies(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "serving")
    versions.publish_version(spark, {"t": spark.createDataFrame([], "a int")}, root)
    assert versions.read_version(spark, root, "t").columns == ["a"] and versions.read_version(spark, root, "t").isEmpty()
    monkeypatch.setattr(versions, "_sums", lambda df, part: {"all": (2, 0, 0)})
    with pytest.raises(PublishError):
        versions.publish_version(spark, {"t": spark.createDataFrame([(1,)], "a int")}, root)
    assert len(versions.versions(spark, root)) == 1


@pytest.mark.parametrize("buckets", [(4, 16), (1,), reconcile.BUCKETS])
def test_rows_that_cancel_out_are_found(spark, buckets):
    left = spark.createDataFrame([(k % 7, None if k % 5 == 0 else k) for k in range(200)] * 2, "g int, v int")
    moved = F.when((F.col("v") == 11), 12).when(F.col("v") == 13, 12).otherwise(F.col("v"))
    right = left.withColumn("v", moved)
    assert left.agg(F.sum("v")).first() == right.agg(F.sum("v")).first()
    got = {(r.g, r.v): (r.quantidade_silver, r.quantidade_gold) for r in reconcile.row_differences(left, right, ["g", "v"], buckets).collect()}
    assert got == {(4, 11): (2, 0), (6, 13): (2, 0), (4, 12): (0, 2), (6, 12): (0, 2)}
    assert reconcile.row_differences(left, left.repartition(7), ["g", "v"], buckets).isEmpty()


def test_silver_and_fact_agree_row_by_row(spark):
    rows = silver(spark, {}, dict(nr_empenho="2"), dict(nr_empenho="2", mes=2))
    assert reconcile.expense_row_differences(rows, FC.fct_expense(rows)).isEmpty()
    assert reconcile.expense_row_differences(rows, FC.fct_expense(rows.where("mes = 1"))).count() == 1


def test_tables_by_name_join_without_moving_the_fact(spark):
    rows = silver(spark, *[dict(nr_empenho=str(k), id_fornecedor=f"CNPJ - {k % 20}", evento="Valor Pago") for k in range(200)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = [
            catalog.register(spark, t, df, "test_", buckets=8)
            for t, df in (("fct_despesas", FC.fct_expense(rows)), ("dim_fornecedor", D.dim_supplier(rows)))
        ]
        assert names == ["test_gold.fct_despesas", "test_gold.dim_fornecedor"]
        found = indicators.expense_by_supplier(*[catalog.read(spark, t, "test_") for t in ("fct_despesas", "dim_fornecedor")])
        assert found.count() == 20
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        stats = spark.sql("describe extended test_gold.fct_despesas").where("col_name = 'Statistics'").first()
        assert "200 rows" in stats.data_type
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        catalog.drop_lake(spark, "test_")


RECORD = "municipio string, exercicio int, mes_particao int, orgao string, mes string, evento string, nr_empenho string, id_fornecedor string, nm_fornecedor string, dt_emissao_despesa string, vl_despesa string"


def test_a_replayed_or_late_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "bronze")
    lake, manifest = months.MonthLake(spark, str(tmp_path / "lake")), f"{root}/manifest"

    def land(stamp, number, mes=1):
        row = dict(municipio="salto", exercicio=2021, mes_particao=mes, **expense(nr_empenho=number))
        names = [c.split()[0] for c in RECORD.split(", ")]
        records = spark.createDataFrame([tuple(row[n] for n in names)], RECORD)
        landing.land(records, root, manifest, EXPENSES, planned=records, stamp=stamp)

    def stored():
        return sorted(r.nr_empenho for r in lake.read("fct_despesas").collect())

    run = lambda: refresh.start_refresh(lake, manifest, str(tmp_path / "checkpoint"), as_of=date(2021, 6, 1)).awaitTermination()
    land("20210201T000000Z", "one")
    run()
    old = spark.read.text(manifest).collect()
    land("20210301T000000Z", "two")
    land("20210301T000001Z", "other", mes=2)
    run()
    assert stored() == ["other", "two"]
    log = lake.last_batch()
    run()
    assert refresh.is_applied(lake, "refresh", 0) and refresh.is_applied(lake, "refresh", 1)
    late = spark.createDataFrame(old, "value string")
    refresh.apply_batch(lake, "refresh", None, late, 1)  # noted: passed over
    refresh.apply_batch(lake, "refresh", None, late, 7)  # not noted, but older than what is built
    assert stored() == ["other", "two"] and lake.last_batch() == log
    # a line that is no manifest row stops nothing
    refresh.apply_batch(lake, "refresh", None, spark.createDataFrame([("{",), ("",)], "value string"), 8)
    assert stored() == ["other", "two"]
