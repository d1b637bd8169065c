"""Golden rows of every dimension and fact, and the numbering of copies."""

import hashlib
import re
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fiscalake.operators import dimensions as D
from fiscalake.operators import facts as FC
from fiscalake.operators.occurrences import number_copies
from fiscalake.operators.reconcile import reconcile_expenses, reconcile_revenues

EXPENSE = (
    "municipio string, exercicio int, mes int, orgao string, evento string, nr_empenho string, "
    "id_fornecedor string, nm_fornecedor string, dt_emissao_despesa date, "
    "vl_despesa decimal(18,2), arquivo_origem string"
)
REVENUE = (
    "municipio string, exercicio int, mes int, orgao string, ds_fonte_recurso string, "
    "ds_cd_aplicacao_fixo string, ds_alinea string, ds_subalinea string, "
    "vl_arrecadacao decimal(18,2), arquivo_origem string"
)


def md5(*parts):
    return hashlib.md5("||".join(parts).encode()).hexdigest()


def expense_row(**changes):
    row = {
        "municipio": "salto",
        "exercicio": 2021,
        "mes": 1,
        "orgao": "CAMARA",
        "evento": "Empenhado",
        "nr_empenho": "1",
        "id_fornecedor": "CNPJ - 1",
        "nm_fornecedor": "ALFA",
        "dt_emissao_despesa": date(2021, 1, 9),
        "vl_despesa": Decimal("10.00"),
        "arquivo_origem": "f1",
    }
    return {**row, **changes}


def revenue_row(**changes):
    row = {
        "municipio": "salto",
        "exercicio": 2021,
        "mes": 2,
        "orgao": "CAMARA",
        "ds_fonte_recurso": "02 - ESTADO",
        "ds_cd_aplicacao_fixo": "110 - GERAL",
        "ds_alinea": "1.1 - TAXA - LOCAL",
        "ds_subalinea": "11 - TAXA",
        "vl_arrecadacao": Decimal("5.00"),
        "arquivo_origem": "f1",
    }
    return {**row, **changes}


@pytest.fixture
def frames(spark):
    def make(expenses=(), revenues=()):
        return (
            spark.createDataFrame([expense_row(**c) for c in expenses], EXPENSE),
            spark.createDataFrame([revenue_row(**c) for c in revenues], REVENUE),
        )

    return make


def expense_dims(exp, rev):
    return FC.ExpenseDimensions(
        D.dim_municipality(exp, rev), D.dim_organisation(exp, rev), D.dim_supplier(exp)
    )


def revenue_dims(exp, rev):
    return FC.RevenueDimensions(
        D.dim_municipality(exp, rev),
        D.dim_organisation(exp, rev),
        D.dim_source(rev),
        D.dim_application(rev),
        D.dim_class(rev),
        D.dim_subclass(rev),
    )


def test_places(frames):
    exp, rev = frames([{}, {"municipio": "itu"}], [{"orgao": "SAAE"}])
    places = {r.municipio: tuple(r) for r in D.dim_municipality(exp, rev).collect()}
    assert places == {
        "salto": (md5("salto"), "salto", "Salto", "SP"),
        "itu": (md5("itu"), "itu", "itu", None),
    }
    orgs = {tuple(r) for r in D.dim_organisation(exp, rev).collect()}
    assert orgs == {
        (md5(m, o), md5(m), m, o)
        for m, o in (("salto", "CAMARA"), ("itu", "CAMARA"), ("salto", "SAAE"))
    }


def test_calendar_is_gap_free(frames):
    exp, rev = frames([{"exercicio": 2020, "mes": 11}, {"mes": None}], [{}])
    rows = D.dim_calendar(exp, rev, date(2021, 7, 20)).orderBy("tempo_sk").collect()
    assert [r.tempo_sk for r in rows] == [202011, 202012, *range(202101, 202108)]
    assert tuple(rows[0]) == (202011, date(2020, 11, 1), 2020, 11, "Novembro", 4, 2, "2020-11")
    assert tuple(rows[-2])[4:] == ("Junho", 2, 1, "2021-06")


def test_calendar_without_periods_is_empty(frames):
    exp, rev = frames([{"mes": None}], [])
    assert D.dim_calendar(exp, rev, date(2021, 7, 20)).count() == 0
    exp, rev = frames([{}], [])
    assert D.dim_calendar(exp, rev, date(2020, 1, 1)).count() == 0


def test_supplier_current_name(frames):
    late, early = date(2021, 5, 1), date(2020, 5, 1)
    seen = [
        # latest date wins over frequency
        *[{"nm_fornecedor": "OLD", "dt_emissao_despesa": early}] * 3,
        # on that date the more frequent name wins
        *[{"nm_fornecedor": "BETA", "dt_emissao_despesa": late}] * 2,
        {"nm_fornecedor": "ALFA", "dt_emissao_despesa": late},
        # equal counts: first by name
        {"id_fornecedor": "CNPJ - 2", "nm_fornecedor": "Z", "dt_emissao_despesa": late},
        {"id_fornecedor": "CNPJ - 2", "nm_fornecedor": "Y", "dt_emissao_despesa": late},
        # NULL date and NULL name come last
        {"id_fornecedor": "RG - 3", "nm_fornecedor": "N", "dt_emissao_despesa": None},
        {"id_fornecedor": "RG - 3", "nm_fornecedor": "M", "dt_emissao_despesa": early},
        {"id_fornecedor": "RG - 4", "nm_fornecedor": None},
        {"id_fornecedor": "RG - 4", "nm_fornecedor": "K"},
        # persons are told apart by name
        {"id_fornecedor": "PESSOA FÍSICA - 5", "nm_fornecedor": "ANA"},
        {"id_fornecedor": "PESSOA FÍSICA - 5", "nm_fornecedor": "EVA"},
        # no key, no member
        {"id_fornecedor": None},
    ]
    exp, _ = frames(seen)
    rows = {r.fornecedor_bk: r for r in D.dim_supplier(exp).collect()}
    assert {k: r.nm_fornecedor_atual for k, r in rows.items()} == {
        "CNPJ - 1": "BETA",
        "CNPJ - 2": "Y",
        "RG - 3": "M",
        "RG - 4": "K",
        "PESSOA FÍSICA - 5||ANA": "ANA",
        "PESSOA FÍSICA - 5||EVA": "EVA",
    }
    first = rows["CNPJ - 1"]
    assert tuple(first) == (
        md5("CNPJ - 1"), "CNPJ - 1", "CNPJ - 1", "CNPJ", "BETA", early, late, 3,
    )
    assert rows["RG - 4"].qtd_nomes_observados == 1


def test_code_dimensions(frames):
    _, rev = frames([], [{}, {}, {"ds_subalinea": None}, {"ds_alinea": None}])
    assert [tuple(r) for r in D.dim_source(rev).collect()] == [
        (md5("02 - ESTADO"), "02", "ESTADO", "02 - ESTADO")
    ]
    assert [r.nm_aplicacao for r in D.dim_application(rev).collect()] == ["GERAL"]
    classes = {tuple(r) for r in D.dim_class(rev).collect()}
    text = "1.1 - TAXA - LOCAL"
    assert classes == {(md5(text), "1.1", "TAXA - LOCAL", text), (None,) * 4}
    assert {tuple(r) for r in D.dim_subclass(rev).collect()} == {
        (md5("SUBALINEA", "11 - TAXA"), "11", "TAXA", "11 - TAXA", False),
        ("-1", None, "Não informada", "Não informada", True),
    }


def test_expense_fact(frames):
    exp, rev = frames(
        [
            {},
            {"id_fornecedor": "PESSOA FÍSICA - 5", "nm_fornecedor": "ANA", "mes": None},
            {"id_fornecedor": None},
            {"orgao": None},
        ]
    )
    derived = FC.fct_expense(exp)
    joined = FC.fct_expense(exp, expense_dims(exp, rev))
    rows = {r.id_fornecedor: r for r in derived.collect()}
    assert sorted(map(str, rows.values())) == sorted(map(str, joined.collect()))
    assert derived.columns == joined.columns
    row = rows["CNPJ - 1"]
    content = ("salto", "2021", "1", "CAMARA", "Empenhado", "1", "CNPJ - 1", "ALFA")
    assert row.despesa_sk == md5(*content, "2021-01-09", "10.00")
    assert (row.tempo_sk, row.orgao_sk) == (202101, md5("salto", "CAMARA"))
    assert rows["PESSOA FÍSICA - 5"].fornecedor_sk == md5("PESSOA FÍSICA - 5", "ANA")
    assert rows["PESSOA FÍSICA - 5"].tempo_sk is None


def test_a_row_unknown_to_a_dimension_is_dropped_by_the_join(frames):
    exp, rev = frames([{}, {"orgao": "SAAE"}])
    known = expense_dims(exp.where("orgao = 'CAMARA'"), rev)
    assert [r.orgao_sk for r in FC.fct_expense(exp, known).collect()] == [md5("salto", "CAMARA")]


def check_revenue_fact(rows):
    copies = [r for r in rows if r.subalinea_sk == md5("SUBALINEA", "11 - TAXA")]
    assert sorted(r.nr_ocorrencia for r in copies) == [1, 2, 3, 4, 5]
    assert len({r.receita_fingerprint for r in copies}) == 1
    for r in rows:
        assert r.receita_sk == md5(r.receita_fingerprint, str(r.nr_ocorrencia))
    assert len({r.receita_sk for r in rows}) == len(rows)


@pytest.mark.parametrize("copies_per_task", [100_000, 2])
def test_revenue_fact_numbers_copies(frames, copies_per_task):
    """The same rows whether copies are written by one task or spread over several."""
    exp, rev = frames(
        [], [*[{}] * 4, {"arquivo_origem": "f2"}, {"ds_subalinea": None}, {"ds_alinea": None}]
    )
    derived = FC.fct_revenue(rev, copies_per_task=copies_per_task)
    joined = FC.fct_revenue(rev, revenue_dims(exp, rev), copies_per_task)
    rows = derived.collect()
    assert len(rows) == 6
    check_revenue_fact(rows)
    assert Counter(map(str, rows)) == Counter(map(str, joined.collect()))
    missing = next(r for r in rows if r.ds_subalinea is None)
    assert missing.subalinea_sk == "-1"
    keys = (md5("salto"), md5("salto", "CAMARA"), "202102", md5("02 - ESTADO"))
    tail = (md5("110 - GERAL"), md5("1.1 - TAXA - LOCAL"), "-1", "5.00")
    assert missing.receita_fingerprint == md5(*keys, *tail)


def test_undated_revenue_is_numbered_across_years(frames):
    """Without a month the year is not in the fingerprint; keys must stay unique."""
    _, rev = frames([], [{"mes": None, "exercicio": y} for y in (2020, 2020, 2021, 2022)])
    rows = FC.fct_revenue(rev).collect()
    assert len({r.receita_fingerprint for r in rows}) == 1
    numbered = sorted((r.nr_ocorrencia, r.exercicio) for r in rows)
    assert numbered == [(1, 2020), (2, 2020), (3, 2021), (4, 2022)]


def test_a_source_text_like_the_missing_member_does_not_multiply_rows(frames):
    exp, rev = frames([], [{"ds_subalinea": "Não informada"}])
    rows = FC.fct_revenue(rev, revenue_dims(exp, rev)).collect()
    assert [r.subalinea_sk for r in rows] == [md5("SUBALINEA", "Não informada")]
    assert list(map(str, rows)) == list(map(str, FC.fct_revenue(rev).collect()))


@pytest.mark.parametrize("copies_per_task", [1000, 7, 1])
def test_numbering_is_complete_for_a_dominant_group(spark, copies_per_task):
    groups = spark.createDataFrame([("hot", 500), ("cold", 1), ("warm", 8)], "k string, n long")
    want = {("hot", i) for i in range(1, 501)} | {("cold", 1)} | {("warm", i) for i in range(1, 9)}
    numbered = number_copies(groups, "n", "i", "k", copies_per_task=copies_per_task)
    rows = [tuple(r) for r in numbered.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_a_dominant_group_is_written_by_several_tasks(spark):
    groups = spark.createDataFrame([("hot", 4000)], "k string, n long")
    spread = number_copies(groups, "n", "i", "k", copies_per_task=100)
    tasks = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 4000


def test_copies_are_counted_in_one_scan_and_one_shuffle(frames):
    _, rev = frames([], [{}] * 3)
    df = FC.fct_revenue(rev)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("partial_count") == 1


def test_reconciliation(frames):
    exp, rev = frames(
        [{}, {"evento": "Valor Pago"}, {"evento": None}], [{}, {}, {"municipio": "itu"}]
    )
    fact = FC.fct_expense(exp)
    gaps = reconcile_expenses(exp, fact.where("evento = 'Empenhado' or evento is null")).collect()
    by_event = {(r.evento, r.quantidade_silver, r.quantidade_gold) for r in gaps}
    # a NULL group never pairs: it is reported from both sides
    assert by_event == {("Valor Pago", 1, None), (None, 1, None), (None, None, 1)}

    places = D.dim_municipality(exp, rev)
    revenues = FC.fct_revenue(rev)
    assert reconcile_revenues(rev, revenues, places).count() == 0
    short = reconcile_revenues(rev, revenues.where("nr_ocorrencia = 1"), places).collect()
    assert [(r.municipio, r.exercicio, r.mes) for r in short] == [("salto", 2021, 2)]
    assert (short[0].valor_silver, short[0].valor_gold) == (Decimal("10.00"), Decimal("5.00"))


def _dimensions(spark, expenses, revenues, subclass):
    return FC.RevenueDimensions(
        D.dim_municipality(expenses, revenues),
        D.dim_organisation(expenses, revenues),
        D.dim_source(revenues),
        D.dim_application(revenues),
        D.dim_class(revenues),
        subclass,
    )


def test_revenue_keys_are_unique_without_a_year(spark):
    rows = [revenue_row(exercicio=None, mes=m) for m in (1, 2, 2)] + [revenue_row(exercicio=2020, mes=None)]
    fact = FC.fct_revenue(spark.createDataFrame(rows, REVENUE)).collect()
    assert len(fact) == 4 and len({r.receita_sk for r in fact}) == 4
    assert len({r.receita_fingerprint for r in fact}) == 1


def test_revenue_keys_are_unique_where_members_are_missing(spark):
    texts = (None, "11 - A", "12 - B", "12 - B", "13 - C")
    revenues = spark.createDataFrame([revenue_row(ds_subalinea=t) for t in texts], REVENUE)
    expenses = spark.createDataFrame([expense_row()], EXPENSE)
    known = D.dim_subclass(revenues).where("ds_subalinea = '11 - A' or is_nao_informada")
    fact = FC.fct_revenue(revenues, _dimensions(spark, expenses, revenues, known)).collect()
    assert len(fact) == 5 and len({r.receita_sk for r in fact}) == 5
    assert sorted(r.nr_ocorrencia for r in fact if r.subalinea_sk == "-1") == [1, 2, 3, 4]


@pytest.mark.parametrize("kind", ["expense", "revenue"])
def test_fact_rows_never_move_by_municipality(spark, kind):
    """With nothing broadcast, only distinct tuples and dimensions meet on these keys."""
    expenses = spark.createDataFrame([expense_row()], EXPENSE)
    revenues = spark.createDataFrame([revenue_row()], REVENUE)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        if kind == "expense":
            dims = FC.ExpenseDimensions(
                D.dim_municipality(expenses, revenues), D.dim_organisation(expenses, revenues), D.dim_supplier(expenses)
            )
            fact, amount = FC.fct_expense(expenses, dims), "vl_despesa"
        else:
            fact = FC.fct_revenue(revenues, _dimensions(spark, expenses, revenues, D.dim_subclass(revenues)))
            amount = "vl_arrecadacao"
        plan = spark._jvm.PythonSQLUtils.explainString(fact._jdf.queryExecution(), "formatted")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((.*), \d+\)", plan)
    assert exchanges
    for columns, keys in exchanges:
        names = [k.strip().split("#")[0].split("(")[-1] for k in keys.split(",")]
        if amount in columns:
            assert not set(names) <= {"municipio", "orgao"}, names
