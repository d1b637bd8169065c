import json
from datetime import date

import pytest
from conftest import expense, revenue
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from test_runs import _full_run, run

from fiscalake import session
from fiscalake.operators import indicators
from fiscalake.plans import lake, publish
from fiscalake.sources import landing
from fiscalake.sources.schemas import EXPENSES, REVENUES


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, description string")


def test_tables_are_published_with_their_counts(spark, tmp_path):
    root = str(tmp_path / "serving")
    names = [t for t in lake.GOLD_TABLES if not lake.partitioning(t)]
    counts = publish.publish(spark, {t: frame(spark, t) for t in names}, root)
    assert counts == dict.fromkeys(names, 1)
    assert publish.read_published(spark, root, "dim_orgao").first().description == "dim_orgao"
    listed = {r.table: r.rows for r in publish.published_counts(spark, root).collect()}
    assert listed == counts


def test_a_new_version_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path / "serving")
    publish.publish(spark, {"t": frame(spark, "old")}, root)
    first = publish.current_version(spark, root)
    publish.publish(spark, {"t": frame(spark, "new", "newer")}, root)
    assert publish.current_version(spark, root) > first
    assert publish.read_published(spark, root, "t").count() == 2


def test_a_failure_keeps_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "serving")
    publish.publish(spark, {"t": frame(spark, "old")}, root)
    missing = spark.range(1).selectExpr("raise_error('gone') as description")
    with pytest.raises(PySparkException):
        publish.publish(spark, {"t": frame(spark, "new"), "u": missing}, root)
    assert publish.read_published(spark, root, "t").first().description == "old"


def test_a_short_copy_is_not_published(spark, tmp_path):
    root = str(tmp_path / "serving")

    class Short:
        """A source that counts more rows than it writes."""

        write = frame(spark, "a").write

        @staticmethod
        def count():
            return 2

    with pytest.raises(publish.PublishError):
        publish.publish(spark, {"t": Short()}, root)
    assert publish.current_version(spark, root) is None


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, str(tmp_path), "t")


def test_build_and_publish_end_to_end(spark, land_file, tmp_path):
    land_file(EXPENSES, 2021, 1, "20210101T100000Z", [expense(evento="Valor Pago")] * 2)
    land_file(
        EXPENSES,
        2021,
        1,
        "20210101T120000Z",
        [expense(evento="Valor Pago"), expense(), expense(evento="Valor Pago", nr_empenho="8")],
    )
    land_file(REVENUES, 2021, 2, "20210201T100000Z", [revenue()] * 3)
    built = lake.build(spark, land_file.root, str(tmp_path / "lake"), date(2021, 6, 1))
    runs = str(tmp_path / "runs")
    landing.append_full_runs(_full_run(spark), runs)
    ingestion = tmp_path / "ingestion.jsonl"
    ingestion.write_text(f"{json.dumps(run())}\n{json.dumps(run(status='empty'))}\n")
    root = str(tmp_path / "serving")
    counts = publish.publish_lake(built, root, str(ingestion), runs)
    published = publish.read_published(spark, root, "ops.ingestion_runs")
    assert dict(published.dtypes)["completed_at_utc"] == "timestamp"
    assert counts == {
        "dim_municipio": 1, "dim_orgao": 1, "dim_tempo": 6, "dim_fornecedor": 1,
        "dim_fonte_recurso": 1, "dim_aplicacao": 1, "dim_alinea": 1, "dim_subalinea": 2,
        "fct_despesas": 3, "fct_receitas": 3, "ops.ingestion_runs": 2, "ops.pipeline_runs": 1,
    }
    exp, rev = built.read("fct_despesas"), built.read("fct_receitas")
    places = built.read("dim_municipio")
    balance = indicators.monthly_balance(exp, rev, places).orderBy("mes").collect()
    # the commitment is left out: amounts of different events do not add up
    assert [(r.mes, str(r.receita), str(r.despesa), str(r.saldo_acumulado)) for r in balance] == [
        (1, "0.00", "5001.50", "-5001.50"),
        (2, "29629.62", "0.00", "24628.12"),
    ]
    by_org = indicators.expense_by_organisation(exp, built.read("dim_orgao")).first()
    assert (by_org.nm_orgao, by_org.lancamentos) == ("CAMARA", 2)
    by_supplier = indicators.expense_by_supplier(exp, built.read("dim_fornecedor")).first()
    assert (by_supplier.nm_fornecedor_atual, str(by_supplier.valor)) == ("ALFA LTDA", "5001.50")


def test_tables_kept_by_year_are_written_without_sorting(spark, tmp_path, monkeypatch):
    """A sort would hold all rows of a task; the session's setting is put back."""
    setting, used = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(setting, None)
    parquet = DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        used.append((path, int(spark.conf.get(setting, "0"))))
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    # more years than a task keeps files of
    years = session.OPEN_WRITERS + 10
    columns = [f"cast(null as {c.split(' ', 1)[1]}) as {c.split()[0]}" for c in lake.PARTITIONED_SCHEMAS["fct_despesas"].split(", ")]
    columns = [c for c in columns if not c.endswith(" as exercicio")]
    rows = spark.range(0, 3 * years, 1, 1).selectExpr(*columns, f"cast(id % {years} as int) as exercicio")
    built = lake.Lake(spark, str(tmp_path / "lake"))
    built.write("fct_despesas", rows)
    publish.publish(spark, {"fct_despesas": built.read("fct_despesas")}, str(tmp_path / "serving"))
    assert len(used) == 2 and all(n > 0 for _, n in used)
    found = publish.read_published(spark, str(tmp_path / "serving"), "fct_despesas").groupBy("exercicio").count()
    assert [tuple(r) for r in found.orderBy("exercicio").collect()] == [(y, 3) for y in range(years)]
    assert spark.conf.get(setting, None) == before
