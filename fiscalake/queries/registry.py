"""Registered queries: name -> (Spark query, SQL or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalake.functions.parse import br_date, br_decimal, month_number
from fiscalake.functions.text import is_blank, is_filled
from fiscalake.operators import contracts, indicators, profile, quality, reconcile, runs
from fiscalake.operators import dimensions as D
from fiscalake.operators import facts as FC
from fiscalake.operators import periods
from fiscalake.plans import catalog, lake, months, publish, versions
from fiscalake.plans.checks import run_all_checks
from fiscalake.plans.silver import silver_expenses
from fiscalake.queries import derive as S
from fiscalake.queries.oracle import (
    _EVENTS,
    _MONTH_NUMBERS,
    _TYPES,
    EXPENSE_CONTENT,
    REVENUE_CONTENT,
    _money,
    _month,
    rows,
    sql,
)
from fiscalake.session import scratch_path
from fiscalake.sources import landing, manifests, snapshots, tail
from fiscalake.sources.schemas import BRONZE_COLUMNS, EXPENSES, REVENUES, SOURCE_PATH
from fiscalake.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, tuple[Query, str | None]] = {}

TOTAL = "decimal(28,2)"


def _query(oracle: str | None = None, name: str | None = None):
    def register(run: Query) -> Query:
        _QUERIES[name or run.__name__] = (run, oracle)
        return run

    return register


def _decimals(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(TOTAL) for c in columns})


# ---- snapshots ------------------------------------------------------------------


@_query(rows("parts"))
def snapshot_path_parts(spark, sf):
    return snapshots.with_partition(S.snapshot_files(spark, sf)).drop("snapshot")


@_query(rows("newest"))
def latest_snapshot(spark, sf):
    return snapshots.latest_snapshots(snapshots.with_partition(S.snapshot_files(spark, sf)))


@_query(
    sql(
        """select p.path as arquivo_origem, cast(unnest(range(1, p.records + 1)) as integer) as record
        from parts p join newest n on n.snapshot = p.path""",
        "newest",
    )
)
def rows_of_latest_snapshot(spark, sf):
    files = S.snapshot_files(spark, sf)
    records = F.when(F.col("records") > 0, F.sequence(F.lit(1), F.col("records")))
    contents = files.select(F.col("path").alias(SOURCE_PATH), F.explode(records).alias("record"))
    return snapshots.rows_of_latest(contents, snapshots.with_partition(files))


def _orders_as_records(spark, sf) -> DataFrame:
    return S.expense_records(S.table(spark, sf, "orders"))


@_query(sql("select * exclude (arquivo_origem) from stg_exp", "stg_exp"))
def bronze_json_roundtrip(spark, sf):
    """Land the records as snapshots, then read the latest ones back as Silver."""
    root = scratch_path(spark, "bronze")
    landing.write_snapshots(_orders_as_records(spark, sf), root, EXPENSES, S.STAMP)
    return silver_expenses(snapshots.read_latest(spark, root, EXPENSES)).drop(SOURCE_PATH)


@_query(
    sql(
        """select 'são paulo 5%' as municipio, exercicio, mes, orgao, evento, nr_empenho, id_fornecedor,
          nm_fornecedor, dt_emissao_despesa, vl_despesa
        from stg_exp where mes <> 12""",
        "stg_exp",
    )
)
def latest_rows_from_files(spark, sf):
    """Two stamps of every month land; the newer one corrects all and empties December."""
    root = scratch_path(spark, "odd names [1]")
    name = F.lit("são paulo 5%").alias("municipio")
    records = _orders_as_records(spark, sf).withColumn("municipio", name)
    planned = records.select(*snapshots.PARTITION).distinct()
    stale = records.withColumn("nr_empenho", F.lit("superseded"))
    landing.write_snapshots(stale, root, EXPENSES, "20230101T000000Z")
    landing.write_snapshots(records.where("mes_particao <> 12"), root, EXPENSES, S.STAMP, planned)
    return silver_expenses(snapshots.read_latest(spark, root, EXPENSES)).drop(SOURCE_PATH)


def _landed_json_sql(columns: str) -> str:
    parts = " || ',' || ".join(f"""'"{c.strip()}":' || to_json({c.strip()})""" for c in columns.split(","))
    return f"'[{{' || {parts} || '}}]' || chr(10)"


_WORDS = " || ".join(
    f"lpad(to_hex(sum(('0x' || substr(sha, {8 * k + 1}, 8))::bigint)::bigint % 4294967296), 8, '0')" for k in range(8)
)


@_query(
    sql(
        f"""select municipio as municipality, exercicio as year, mes_particao as month,
          count(*)::bigint as records, lower({_WORDS}) as checksum
        from (select *, sha256(rtrim({_landed_json_sql('orgao, mes, evento, nr_empenho, id_fornecedor, nm_fornecedor, dt_emissao_despesa, vl_despesa')}, chr(10))) as sha
              from raw_exp) group by all""",
        "raw_exp",
    )
)
def landed_checksums(spark, sf):
    """All records land; a checksum of each month's content, however it is dealt over files."""
    base = scratch_path(spark, "landed")
    landing.write_snapshots(_orders_as_records(spark, sf), base, EXPENSES, S.STAMP)
    return landing.content_checksums(spark, base, EXPENSES, S.STAMP)


@_query(
    sql(
        f"""select municipio as municipality, exercicio as year, mes_particao as month,
          count(*)::bigint as record_count, sum(strlen(line))::bigint as content_length_bytes
        from (select *, {_landed_json_sql('orgao, mes, evento, nr_empenho, id_fornecedor, nm_fornecedor, dt_emissao_despesa, vl_despesa')} as line
              from raw_exp) group by all""",
        "raw_exp",
    )
)
def landed_bytes(spark, sf):
    """Records and bytes of all that landed; the tests compare checksums with the files'."""
    records = _orders_as_records(spark, sf)
    base = scratch_path(spark, "landed")
    landing.land(records, base, f"{base}/manifest", EXPENSES, planned=records)
    runs_ = manifests.read_ingestion_runs(spark, f"{base}/manifest")
    return runs_.select("municipality", "year", "month", "record_count", "content_length_bytes")


@_query(
    sql(
        """select 'despesas' as dataset, municipio as municipality, exercicio as year,
          mes_particao as month, case when n = 0 then 'empty' else 'success' end as status,
          cast(n as bigint) as record_count
        from (select municipio, exercicio, mes_particao,
                count_if(o_totalprice is not null) as n
              from raw_exp r left join (select o_orderkey, o_totalprice from orders
                                        where o_orderstatus = 'F') o on o.o_orderkey = r.k
              group by all)""",
        "raw_exp",
    )
)
def snapshot_manifest(spark, sf):
    """Only liquidations arrive; planned months without any become empty snapshots."""
    records = _orders_as_records(spark, sf)
    arrived = records.where(F.col("evento") == "Valor Liquidado")
    base = scratch_path(spark, "landed")
    landing.land(arrived, base, f"{base}/manifest", EXPENSES, planned=records)
    runs_ = manifests.read_ingestion_runs(spark, f"{base}/manifest")
    return runs_.select("dataset", "municipality", "year", "month", "status", "record_count")


# ---- Silver and Gold -------------------------------------------------------------


@_query(rows("stg_exp"))
def silver_expense(spark, sf):
    return S.expenses(spark, sf)


@_query(rows("stg_bad"))
def silver_expense_with_defects(spark, sf):
    return S.defective_expenses(spark, sf)


@_query(rows("stg_rev"))
def silver_revenue(spark, sf):
    return S.revenues(spark, sf)


@_query(rows("d_mun"))
def dim_municipality(spark, sf):
    return D.dim_municipality(S.expenses(spark, sf), S.revenues(spark, sf))


@_query(
    sql(
        """select municipio_sk, municipio, coalesce(n_name, municipio) as nm_municipio, substr(n_name, 1, 2) as uf
        from d_mun left join nation on 'm' || n_nationkey = municipio and n_nationkey <> 1""",
        "d_mun",
    )
)
def dim_municipality_from_names(spark, sf):
    """Display names from a table; one municipality is missing in it."""
    names = S.table(spark, sf, "nation").where("n_nationkey <> 1").select(
        F.concat(F.lit("m"), "n_nationkey").alias("municipio"),
        F.col("n_name").alias("nm_municipio"),
        F.substring("n_name", 1, 2).alias("uf"),
    )
    return D.dim_municipality(S.expenses(spark, sf), S.revenues(spark, sf), names)


@_query(rows("d_org"))
def dim_org(spark, sf):
    return D.dim_organisation(S.expenses(spark, sf), S.revenues(spark, sf))


@_query(rows("d_cal"))
def dim_calendar(spark, sf):
    last = S.table(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    return D.dim_calendar(S.expenses(spark, sf), S.revenues(spark, sf), as_of=last)


@_query(rows("d_sup"))
def dim_supplier(spark, sf):
    return D.dim_supplier(S.expenses(spark, sf))


@_query(rows("d_sup_bad"))
def dim_supplier_with_defects(spark, sf):
    return D.dim_supplier(S.defective_expenses(spark, sf))


@_query(rows("d_src"))
def dim_source(spark, sf):
    return D.dim_source(S.revenues(spark, sf))


@_query(rows("d_app"))
def dim_application(spark, sf):
    return D.dim_application(S.revenues(spark, sf))


@_query(rows("d_cls"))
def dim_class(spark, sf):
    return D.dim_class(S.revenues(spark, sf))


@_query(rows("d_sub"))
def dim_subclass(spark, sf):
    return D.dim_subclass(S.revenues(spark, sf))


def _expense_dims(exp: DataFrame, rev: DataFrame) -> FC.ExpenseDimensions:
    return FC.ExpenseDimensions(
        D.dim_municipality(exp, rev), D.dim_organisation(exp, rev), D.dim_supplier(exp)
    )


def _revenue_dims(exp: DataFrame, rev: DataFrame) -> FC.RevenueDimensions:
    return FC.RevenueDimensions(
        D.dim_municipality(exp, rev),
        D.dim_organisation(exp, rev),
        D.dim_source(rev),
        D.dim_application(rev),
        D.dim_class(rev),
        D.dim_subclass(rev),
    )


@_query(rows("f_exp"))
def fct_expense(spark, sf):
    return FC.fct_expense(S.expenses(spark, sf, whole=True))


@_query(rows("f_exp"))
def fct_expense_joined(spark, sf):
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    return FC.fct_expense(S.expenses(spark, sf, whole=True), _expense_dims(exp, rev))


@_query(rows("f_bad"))
def fct_expense_with_defects(spark, sf):
    return FC.fct_expense(S.defective_expenses(spark, sf))


@_query(rows("f_rev"))
def fct_revenue(spark, sf):
    return FC.fct_revenue(S.revenues(spark, sf, whole=True))


@_query(rows("f_rev"))
def fct_revenue_joined(spark, sf):
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    return FC.fct_revenue(S.revenues(spark, sf, whole=True), _revenue_dims(exp, rev))


@_query(rows("f_rev_bad"))
def fct_revenue_with_defects(spark, sf):
    """Years and months that are unknown; contents that then share a fingerprint."""
    return FC.fct_revenue(S.defective_revenues(spark, sf))


@_query(rows("f_rev_gaps"))
def fct_revenue_joined_with_gaps(spark, sf):
    """The subclass dimension misses every text of an odd length."""
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    bad = S.defective_revenues(spark, sf)
    known = D.dim_subclass(rev).where(F.length("ds_subalinea") % 2 == 0)
    dims = FC.RevenueDimensions(
        D.dim_municipality(exp, rev),
        D.dim_organisation(exp, rev),
        D.dim_source(bad),
        D.dim_application(rev),
        D.dim_class(rev),
        known,
    )
    return FC.fct_revenue(bad, dims)


# ---- quality ---------------------------------------------------------------------

_PLANTED_GAP = "where not (exercicio = 1997 and ds_fonte_recurso = '05 - FEDERAL')"


def _recon_sql(keys: str, silver: str, gold: str, amount: str, *blocks: str) -> str:
    """Both sides in one list, each row with its side; groups in which the sides differ."""
    n = lambda side: f"count(*) filter (side = '{side}')"
    total = lambda side: f"cast(sum({amount}) filter (side = '{side}') as decimal(28,2))"
    return sql(
        f"""select {keys}, nullif({n('silver')}, 0) as quantidade_silver,
          nullif({n('gold')}, 0) as quantidade_gold, {total('silver')} as valor_silver,
          {total('gold')} as valor_gold
        from (select 'silver' as side, {keys}, {amount} from {silver}
              union all select 'gold', {keys}, {amount} from {gold})
        group by {keys}
        having {n('silver')} <> {n('gold')} or {total('silver')} is distinct from {total('gold')}""",
        *blocks,
    )


@_query(_recon_sql("evento", "stg_bad", "f_bad", "vl_despesa", "stg_bad", "f_bad"))
def recon_expense(spark, sf):
    """Rows without a supplier identifier never reach the fact: a real difference."""
    silver = S.defective_expenses(spark, sf)
    found = reconcile.reconcile_expenses(silver, FC.fct_expense(silver))
    return _decimals(found, "valor_silver", "valor_gold")


@_query(
    _recon_sql(
        "municipio, exercicio, mes", "stg_rev", f"(from stg_rev {_PLANTED_GAP})", "vl_arrecadacao", "stg_rev"
    )
)
def recon_revenue(spark, sf):
    """The fact misses one source's rows of one year; Silver holds all of them."""
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    gap = (F.col("exercicio") == 1997) & (F.col("ds_fonte_recurso") == "05 - FEDERAL")
    fact = FC.fct_revenue(S.revenues(spark, sf, whole=True)).where(~gap)
    found = reconcile.reconcile_revenues(rev, fact, D.dim_municipality(exp, rev))
    return _decimals(found, "valor_silver", "valor_gold")


_TESTED = ("orgao", "mes", "evento", "id_fornecedor", "nm_fornecedor", "dt_emissao_despesa", "vl_despesa")


_TWO = "(select min(nr_empenho) from stg_exp where evento = 'Valor Pago'), (select max(nr_empenho) from stg_exp where evento = 'Valor Pago')"


@_query(
    sql(
        f"""select exercicio, mes, evento, nr_empenho, dt_emissao_despesa, id_fornecedor, nm_fornecedor,
          cast(vl_despesa + d as decimal(18,2)) as vl_despesa,
          case when d = 0 then 1 else 0 end::bigint as quantidade_silver,
          case when d = 0 then 0 else 1 end::bigint as quantidade_gold
        from (select *, unnest([0, case when nr_empenho = (select min(nr_empenho) from stg_exp where evento = 'Valor Pago')
                then 1 else -1 end]) as d
              from stg_exp where nr_empenho in ({_TWO}))""",
        "stg_exp",
    )
)
def recon_expense_rows(spark, sf):
    """Two planted amounts of one event that cancel out: sums agree, the rows are found."""
    silver = S.expenses(spark, sf, whole=True)
    paid = silver.where(F.col("evento") == "Valor Pago").agg(F.min("nr_empenho"), F.max("nr_empenho")).first()
    number = F.col("nr_empenho")
    amount = F.when(number == paid[0], F.col("vl_despesa") + 1).when(number == paid[1], F.col("vl_despesa") - 1)
    fact = FC.fct_expense(silver).withColumn("vl_despesa", F.coalesce(amount, "vl_despesa").cast("decimal(18,2)"))
    summed = reconcile.reconcile_expenses(silver, fact)
    found = reconcile.expense_row_differences(silver, fact)
    # nothing is found by sums; a row of theirs would show here
    return found.unionByName(
        summed.select("evento", *[F.lit(None).alias(c) for c in found.columns if c != "evento"])
    )


@_query(
    sql(
        " union all ".join(
            f"""select 'not_null' as "check", '{c}' as "column", 'error' as severity,
            count(*) filter ({c} is null) as failures from stg_bad"""
            for c in _TESTED
        ),
        "stg_bad",
    )
)
def dq_not_null(spark, sf):
    return quality.count_failures(
        S.defective_expenses(spark, sf), [quality.not_null(c) for c in _TESTED]
    )


@_query(
    sql(
        f"""select 'accepted_values' as "check", 'mes' as "column", 'error' as severity,
          count(*) filter (mes not in (1,2,3,4,5,6,7,8,9,10,11,12)) as failures from stg_bad
        union all select 'accepted_values', 'evento', 'error',
          count(*) filter (evento not in ({_EVENTS})) from stg_bad""",
        "stg_bad",
    )
)
def dq_accepted(spark, sf):
    rules = [
        quality.accepted_values("mes", contracts.MONTHS),
        quality.accepted_values("evento", contracts.EXPENSE_EVENTS),
    ]
    return quality.count_failures(S.defective_expenses(spark, sf), rules)


@_query(
    sql(
        f"""select 'valid_month' as "check", 'mes' as "column", 'error' as severity,
          count(*) filter ({_month("trim(mes)")} is null) as failures from raw_bad
        union all select 'valid_value', 'vl_despesa', 'error', count(*) filter (
          vl_despesa is not null and trim(vl_despesa) <> '' and {_money("vl_despesa")} is null)
          from raw_bad
        union all select 'valid_date', 'dt_emissao_despesa', 'error', count(*) filter (
          dt_emissao_despesa is not null and trim(dt_emissao_despesa) <> ''
          and try_strptime(dt_emissao_despesa, '%d/%m/%Y') is null) from raw_bad
        union all select 'not_blank', 'orgao', 'error', count(*) filter (
          orgao is null or trim(orgao) = '') from raw_bad""",
        "raw_bad",
    )
)
def dq_invalid(spark, sf):
    """Text that is there but does not convert, and blanks, on raw records."""
    value, day = F.col("vl_despesa"), F.col("dt_emissao_despesa")
    rules = [
        quality.Rule("valid_month", "mes", lambda: month_number(F.col("mes")).isNull()),
        quality.Rule(
            "valid_value", "vl_despesa", lambda: is_filled(value) & br_decimal(value).isNull()
        ),
        quality.Rule(
            "valid_date", "dt_emissao_despesa", lambda: is_filled(day) & br_date(day).isNull()
        ),
        quality.Rule("not_blank", "orgao", lambda: is_blank(F.col("orgao"))),
    ]
    return quality.count_failures(
        S.defective_expense_records(S.table(spark, sf, "orders")), rules
    )


@_query(
    sql(
        """select nr_empenho, count(*) as quantidade from stg_bad
        where nr_empenho is not null group by 1 having count(*) > 1""",
        "stg_bad",
    )
)
def dq_unique(spark, sf):
    return quality.repeated_values(S.defective_expenses(spark, sf), "nr_empenho")


@_query(
    """select o_custkey as fk, count(*) as child_rows from orders
    where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')
    group by 1"""
)
def dq_relationship(spark, sf):
    """Orders whose customer is outside the parent set."""
    parent = S.table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return quality.orphans(S.table(spark, sf, "orders"), "o_custkey", parent, "c_custkey")


@_query(
    sql(
        """select municipio, exercicio, mes, arquivo_origem from stg_bad
        where exercicio is distinct from
            try_cast(regexp_extract(arquivo_origem, 'exercicio=([0-9]{4})', 1) as integer)
          or mes is distinct from
            try_cast(regexp_extract(arquivo_origem, 'mes=([0-9]{2})', 1) as integer)""",
        "stg_bad",
    )
)
def dq_partition(spark, sf):
    failing = S.defective_expenses(spark, sf).where(quality.partition_mismatch())
    return failing.select("municipio", "exercicio", "mes", SOURCE_PATH)


_EXP_CONTENT = contracts.EXPENSE_CONTRACT.duplicate_columns


@_query(
    sql(
        f"""select {", ".join(_EXP_CONTENT)}, count(*) as quantidade from stg_bad
        group by all having count(*) > 1""",
        "stg_bad",
    )
)
def dq_duplicates_expense(spark, sf):
    return quality.duplicate_groups(S.defective_expenses(spark, sf), list(_EXP_CONTENT))


@_query(
    sql(
        f"""select {", ".join(BRONZE_COLUMNS[REVENUES])},
          regexp_extract(arquivo_origem, 'exercicio=([0-9]{{4}})', 1) as exercicio,
          count(*) as quantidade
        from raw_rev group by all having count(*) > 1""",
        "raw_rev",
    )
)
def dq_duplicates_revenue(spark, sf):
    return profile.duplicate_contents(
        S.revenue_records(S.table(spark, sf, "lineitem")), REVENUES
    )


_CONTRACT = contracts.EXPENSE_CONTRACT
_BAD_PATH = """(exercicio is distinct from
    try_cast(regexp_extract(arquivo_origem, 'exercicio=([0-9]{4})', 1) as integer)
  or mes is distinct from
    try_cast(regexp_extract(arquivo_origem, 'mes=([0-9]{2})', 1) as integer))"""


def _contract_rows() -> list[tuple[str, str, str]]:
    """(check, column, SQL predicate of a failing row) of the expense contract."""
    out = [("nullable", c.name, f"{c.name} is null") for c in _CONTRACT.columns]
    accepted = {"mes": f"mes between 1 and 12", "evento": f"evento in ({_EVENTS})"}
    out += [("accepted_values", c, f"not ({test})") for c, test in accepted.items()]
    for check, _, c in _CONTRACT.value_rules:
        test = f"not ({accepted[c]}) or " if c in accepted else ""
        out.append((check, c, f"{test}{c} is null"))
    out.append(("partition_month_consistency", "mes", _BAD_PATH))
    out += [(kind, c.name, "false") for kind in ("column_present", "column_type") for c in _CONTRACT.columns]
    return out


@_query(
    sql(
        " union all ".join(
            f"""select '{check}' as "check", '{column}' as "column", 'error' as severity,
            count(*) filter ({test}) as failures from stg_bad"""
            for check, column, test in _contract_rows()
        )
        + f""" union all select 'exact_duplicates', '*', 'error', count(*) from (
            select 1 from stg_bad group by {", ".join(_EXP_CONTENT)} having count(*) > 1)""",
        "stg_bad",
    )
)
def dq_contract(spark, sf):
    return contracts.check_contract(S.defective_expenses(spark, sf), _CONTRACT)


def _revenue_contract_sql() -> str:
    """Fixed values of the revenue contract, written out."""
    columns = (
        "municipio exercicio mes orgao ds_fonte_recurso ds_cd_aplicacao_fixo ds_alinea ds_subalinea "
        "vl_arrecadacao arquivo_origem"
    ).split()
    found = [("nullable", c, "error", f"{c} is null") for c in columns if c != "ds_subalinea"]
    found += [
        ("accepted_values", "mes", "error", "mes not between 1 and 12"),
        ("valid_month", "mes", "error", "mes is null or mes not between 1 and 12"),
        ("valid_revenue_value", "vl_arrecadacao", "error", "vl_arrecadacao is null"),
        ("optional_subalinea", "ds_subalinea", "informational", "ds_subalinea is null"),
        ("partition_month_consistency", "mes", "error", _BAD_PATH),
    ]
    found += [(kind, c, "error", "false") for kind in ("column_present", "column_type") for c in columns]
    counted = [
        f"""select '{check}' as "check", '{c}' as "column", '{severity}' as severity,
        count(*) filter ({test}) as failures from stg_rev_bad"""
        for check, c, severity, test in found
    ]
    counted.append(
        f"""select 'potential_exact_duplicates', '*', 'warning', count(*) from (
        select 1 from stg_rev_bad group by {REVENUE_CONTENT} having count(*) > 1)"""
    )
    return sql(" union all ".join(counted), "stg_rev_bad")


@_query(_revenue_contract_sql())
def dq_contract_revenue(spark, sf):
    return contracts.check_contract(S.defective_revenues(spark, sf), contracts.REVENUE_CONTRACT)


@_query(
    sql(
        """select schema_keys, count(*) filter (n > 0) as files, sum(n)::bigint as records
        from (select exercicio, mes_particao, count(*) as n,
                'dt_emissao_despesa,evento,id_fornecedor,mes,nm_fornecedor,nr_empenho,orgao,vl_despesa' as schema_keys
              from raw_exp where mes_particao <> 5 group by all)
        group by schema_keys
        union all select 'empty', count(distinct exercicio), 0 from raw_exp where mes_particao = 5""",
        "raw_exp",
    )
)
def profile_schema_landed(spark, sf):
    """Fields, files and records of landed snapshots; every May is landed without records."""
    root = scratch_path(spark, "bronze")
    records = _orders_as_records(spark, sf).withColumn("municipio", F.lit("m"))
    planned = records.select(*snapshots.PARTITION).distinct()
    landing.write_snapshots(records.where("mes_particao <> 5"), root, EXPENSES, S.STAMP, planned)
    found = profile.profile_dataset_schema(spark, root, EXPENSES)
    empty = found["totals"].select(F.lit("empty"), "empty_files", F.lit(0).cast("bigint"))
    return found["schemas"].union(empty)


# Table -> building block of the SQL side.
_BLOCKS = {
    "stg_despesas": "stg_exp",
    "stg_receitas": "stg_rev",
    "dim_municipio": "d_mun",
    "dim_orgao": "d_org",
    "dim_tempo": "d_cal",
    "dim_fornecedor": "d_sup",
    "dim_fonte_recurso": "d_src",
    "dim_aplicacao": "d_app",
    "dim_alinea": "d_cls",
    "dim_subalinea": "d_sub",
    "fct_despesas": "f_exp",
    "fct_receitas": "f_rev",
}


def _built_lake(spark, sf) -> lake.Lake:
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    last = S.table(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    built = lake.Lake(spark, scratch_path(spark, "lake"))
    lake.write_silver(built, lambda: exp, lambda: rev)
    lake.write_gold(built, last)
    return built


# Fixed values, written out here and not taken from the declarations under test:
# table -> (not null, unique, accepted, relationships as column: parent).
_NOT_NULL = {
    "stg_despesas": "municipio exercicio mes orgao evento nr_empenho id_fornecedor nm_fornecedor "
    "dt_emissao_despesa vl_despesa arquivo_origem",
    "stg_receitas": "municipio exercicio mes orgao ds_fonte_recurso ds_cd_aplicacao_fixo ds_alinea "
    "vl_arrecadacao arquivo_origem",
    "dim_municipio": "municipio_sk municipio nm_municipio uf",
    "dim_orgao": "orgao_sk municipio_sk municipio nm_orgao",
    "dim_tempo": "tempo_sk dt_mes exercicio mes nm_mes trimestre semestre ano_mes",
    "dim_fornecedor": "fornecedor_sk fornecedor_bk id_fornecedor tipo_fornecedor nm_fornecedor_atual "
    "primeira_dt_observada ultima_dt_observada qtd_nomes_observados",
    "fct_despesas": "despesa_sk municipio_sk orgao_sk tempo_sk fornecedor_sk exercicio mes evento "
    "nr_empenho dt_emissao_despesa vl_despesa id_fornecedor nm_fornecedor_origem",
    "fct_receitas": "receita_sk receita_fingerprint nr_ocorrencia municipio_sk orgao_sk tempo_sk "
    "fonte_recurso_sk aplicacao_sk alinea_sk subalinea_sk exercicio mes vl_arrecadacao "
    "nm_orgao_origem ds_fonte_recurso ds_cd_aplicacao_fixo ds_alinea",
}
_UNIQUE = {
    "dim_municipio": "municipio_sk municipio",
    "dim_orgao": "orgao_sk",
    "dim_tempo": "tempo_sk dt_mes ano_mes",
    "dim_fornecedor": "fornecedor_sk fornecedor_bk",
    "fct_despesas": "despesa_sk",
    "fct_receitas": "receita_sk",
}
_ACCEPTED = {
    ("stg_despesas", "mes"): _MONTH_NUMBERS,
    ("stg_despesas", "evento"): _EVENTS,
    ("stg_receitas", "mes"): _MONTH_NUMBERS,
    ("dim_tempo", "mes"): _MONTH_NUMBERS,
    ("dim_tempo", "trimestre"): "1, 2, 3, 4",
    ("dim_tempo", "semestre"): "1, 2",
    ("dim_fornecedor", "tipo_fornecedor"): ", ".join(f"'{t}'" for t in _TYPES),
    ("fct_despesas", "evento"): _EVENTS,
}
_PARENTS = {
    "municipio_sk": "dim_municipio",
    "orgao_sk": "dim_orgao",
    "tempo_sk": "dim_tempo",
    "fornecedor_sk": "dim_fornecedor",
    "fonte_recurso_sk": "dim_fonte_recurso",
    "aplicacao_sk": "dim_aplicacao",
    "alinea_sk": "dim_alinea",
    "subalinea_sk": "dim_subalinea",
}
_CHILDREN = {
    "dim_orgao": "municipio_sk",
    "fct_despesas": "municipio_sk orgao_sk tempo_sk fornecedor_sk",
    "fct_receitas": "municipio_sk orgao_sk tempo_sk fonte_recurso_sk aplicacao_sk alinea_sk subalinea_sk",
}


def _check_sql(table: str, check: str, column: str, severity: str, failures: str) -> str:
    return (
        f"select '{table}' as \"table\", '{check}' as \"check\", '{column}' as \"column\", "
        f"'{severity}' as severity, {failures} as failures"
    )


def _declared_checks_sql(table: str, blocks: dict[str, str]) -> list[str]:
    block = blocks[table]
    conditions = [("not_null", c, f"{c} is null") for c in _NOT_NULL[table].split()]
    for (owner, c), values in _ACCEPTED.items():
        if owner == table:
            conditions.append(("accepted_values", c, f"{c} not in ({values})"))
    if table.startswith("stg_"):
        conditions.append(("partition_consistency", "mes", _BAD_PATH))
    found = [
        _check_sql(table, check, c, "error", f"count(*) filter ({test})") + f" from {block}"
        for check, c, test in conditions
    ]
    for c in _UNIQUE.get(table, "").split():
        repeated = f"select 1 from {block} where {c} is not null group by {c} having count(*) > 1"
        found.append(_check_sql(table, "unique", c, "error", "count(*)") + f" from ({repeated})")
    for c in _CHILDREN.get(table, "").split():
        orphaned = f"{c} is not null and {c} not in (select {c} from {blocks[_PARENTS[c]]} where {c} is not null)"
        found.append(_check_sql(table, "relationships", c, "error", f"count(*) filter ({orphaned})") + f" from {block}")
    return found


def _all_checks_sql(changed: dict[str, str] | None = None) -> str:
    blocks = {**_BLOCKS, **(changed or {})}
    found = [part for table in _NOT_NULL for part in _declared_checks_sql(table, blocks)]
    for table, check, severity, content in (
        ("stg_despesas", "exact_duplicates", "error", EXPENSE_CONTENT),
        ("stg_receitas", "potential_exact_duplicates", "warning", REVENUE_CONTENT),
    ):
        repeated = f"select 1 from {blocks[table]} group by {content} having count(*) > 1"
        found.append(_check_sql(table, check, "*", severity, "count(*)") + f" from ({repeated})")
    for table, silver, fact, keys, amount in (
        ("fct_despesas", blocks["stg_despesas"], blocks["fct_despesas"], "evento", "vl_despesa"),
        (
            "fct_receitas", blocks["stg_receitas"],
            f"(from {blocks['fct_receitas']} join d_mun using (municipio_sk))",
            "municipio, exercicio, mes", "vl_arrecadacao",
        ),
    ):
        sides = (
            f"select {keys}, sum(side) as n, sum(side * {amount}) as v from ("
            f"select {keys}, {amount}, 1 as side from {silver} union all "
            f"select {keys}, {amount}, -1 from {fact}) group by {keys} having n <> 0 or v <> 0"
        )
        found.append(
            _check_sql(table, "reconciles_with_silver", "*", "error", "count(*)") + f" from ({sides})"
        )
    return sql(" union all ".join(found), *dict.fromkeys([*_BLOCKS.values(), *blocks.values()]))


@_query(_all_checks_sql())
def dq_all_checks(spark, sf):
    """Every declared and cross check over all tables built from the given ones."""
    return run_all_checks(_built_lake(spark, sf).tables())


@_query(
    _all_checks_sql({"stg_despesas": "stg_bad", "fct_despesas": "f_bad_twice", "dim_fornecedor": "d_sup_odd"})
)
def dq_all_checks_with_defects(spark, sf):
    """The same over defective expenses, a fact with repeated rows, and a supplier
    dimension that misses identifiers of an odd length."""
    tables = _built_lake(spark, sf).tables()
    bad = S.defective_expenses(spark, sf)
    fact = FC.fct_expense(bad)
    tables["stg_despesas"] = bad
    tables["fct_despesas"] = fact.unionByName(fact.where(F.col("mes") == 3))
    tables["dim_fornecedor"] = tables["dim_fornecedor"].where(F.length("fornecedor_bk") % 2 == 0)
    return run_all_checks(tables)


# ---- profiles --------------------------------------------------------------------


def _profile_sql() -> str:
    month = _month("mes")
    counts = [("total_records", "null", "true")]
    counts += [
        ("null_or_empty", f"'{c}'", f"{c} is null or trim({c}) = ''")
        for c in BRONZE_COLUMNS[EXPENSES]
    ]
    counts += [
        ("invalid_months", "'mes'", f"{month} is null"),
        (
            "partition_month_mismatches",
            "'mes'",
            f"{month} is distinct from "
            "try_cast(regexp_extract(arquivo_origem, 'mes=([0-9]{2})', 1) as integer)",
        ),
        (
            "invalid_monetary_values",
            "'vl_despesa'",
            f"vl_despesa is not null and trim(vl_despesa) <> '' and {_money('vl_despesa')} is null",
        ),
        (
            "invalid_dates",
            "'dt_emissao_despesa'",
            "dt_emissao_despesa is not null and trim(dt_emissao_despesa) <> '' "
            "and try_strptime(dt_emissao_despesa, '%d/%m/%Y') is null",
        ),
    ]
    parts = [
        f"""select '{metric}' as metric, {column} as "column",
        count(*) filter ({test}) as value from raw_bad"""
        for metric, column, test in counts
    ]
    content = ", ".join(BRONZE_COLUMNS[EXPENSES])
    groups = f"""select count(*) as n from raw_bad
        group by {content}, regexp_extract(arquivo_origem, 'exercicio=([0-9]{{4}})', 1)
        having count(*) > 1"""
    parts.append(f"select 'exact_duplicate_groups', null, count(*) from ({groups})")
    parts.append(
        f"select 'exact_duplicate_excess_rows', null, cast(coalesce(sum(n - 1), 0) as bigint) from ({groups})"
    )
    return sql(" union all ".join(parts), "raw_bad")


@_query(_profile_sql())
def profile_quality(spark, sf):
    records = S.defective_expense_records(S.table(spark, sf, "orders"))
    return profile.quality_profile(records, EXPENSES)


@_query(
    sql(
        """select distinct 'mes' as "column", mes as value from raw_bad where mes is not null
        union select distinct 'evento', evento from raw_bad where evento is not null""",
        "raw_bad",
    )
)
def profile_values(spark, sf):
    records = S.defective_expense_records(S.table(spark, sf, "orders"))
    return profile.distinct_values(records, EXPENSES).orderBy("column", "value")


@_query(
    sql(
        """select schema_keys, count(distinct file) as files, count(*) as records
        from prop_keys group by 1""",
        "prop_keys",
    )
)
def profile_schema(spark, sf):
    return profile.schema_profile(S.prop_records(spark, sf))


@_query(sql("select distinct schema_keys, file from prop_keys", "prop_keys"))
def profile_schema_files(spark, sf):
    return profile.schema_files(S.prop_records(spark, sf))


# ---- runs ------------------------------------------------------------------------


def _ingestion(spark, sf) -> manifests.ParsedRuns:
    return manifests.parse_ingestion_runs(S.ingestion_lines(spark, sf))


@_query(rows("ing_runs"))
def ops_ingestion_runs(spark, sf):
    return _ingestion(spark, sf).runs


@_query(
    sql(
        """select line_number as manifest_line_number, reason from ing_reasons
        where reason is not null""",
        "ing_reasons",
    )
)
def ops_ingestion_rejects(spark, sf):
    return _ingestion(spark, sf).rejects


@_query(rows("full_runs"))
def ops_full_runs(spark, sf):
    return manifests.parse_full_runs(S.full_run_lines(spark, sf)).runs


@_query(
    sql(
        """select dataset, count(*) as total, count(*) filter (status = 'success') as success,
          count(*) filter (status = 'empty') as empty,
          count(*) filter (status = 'failed') as failed
        from ing_runs group by 1""",
        "ing_runs",
    )
)
def ops_batch_summary(spark, sf):
    return runs.batch_summary(_ingestion(spark, sf).runs, "dataset")


@_query(
    sql(
        """select * from (
          select d as dataset, 'm' || user_id as municipio, cast(y as integer) as exercicio,
            cast(m as integer) as mes
          from (select distinct user_id from events)
          cross join (select unnest(['despesas', 'receitas']) as d)
          cross join (select unnest(range(2023, 2025)) as y)
          cross join (select unnest(range(1, 13)) as m)
          where y < 2024 or m <= 9) p
        where not exists (
          select 1 from (select case when event_id % 2 = 0 then 'despesas' else 'receitas' end as d,
              'm' || user_id as u, event_id % 12 + 1 as m from events
              where event_type not in ('error', 'signup')) r
          where r.d = p.dataset and r.u = p.municipio and p.exercicio = 2024 and r.m = p.mes)"""
    )
)
def ops_period_gaps(spark, sf):
    """Months of each municipality still to be loaded; two event types are failures."""
    events = S.table(spark, sf, "events")
    municipality = F.concat(F.lit("m"), F.col("user_id").cast("string"))
    plan = periods.load_plan(
        periods.with_months(events.select(municipality.alias("municipio")).distinct(), 2023, 2024, 9)
    )
    loads = events.select(
        F.when(F.col("event_id") % 2 == 0, EXPENSES).otherwise(REVENUES).alias("dataset"),
        municipality.alias("municipality"),
        F.lit(2024).alias("year"),
        (F.col("event_id") % 12 + 1).cast("int").alias("month"),
        F.when(F.col("event_type").isin("error", "signup"), "failed")
        .when(F.col("event_type") == "view", "empty")
        .otherwise("success")
        .alias("status"),
    )
    return periods.missing_periods(plan, loads)


@_query(
    """select d as dataset, 'm' || user_id as municipio, cast(m // 12 as integer) as exercicio,
      cast(m % 12 + 1 as integer) as mes
    from (select distinct user_id from events) u, (select unnest(['despesas', 'receitas']) as d),
      (select unnest(range((year(t) - 1) * 12, year(t) * 12 + month(t))) as m from (select max(ts) as t from events))
    where not exists (select 1 from events e where e.user_id = u.user_id and e.event_type = 'view'
      and m = year(e.ts) * 12 + month(e.ts) - 1
      and d = case when e.event_id % 2 = 0 then 'despesas' else 'receitas' end)"""
)
def ops_recurring_gaps(spark, sf):
    """Months that a recurring load as of the last event still lacks; views are its loads."""
    events = S.table(spark, sf, "events")
    today = events.agg(F.max("ts").cast("date")).first()[0]
    municipality = F.concat(F.lit("m"), F.col("user_id").cast("string"))
    municipalities = events.select(municipality.alias("municipio")).distinct()
    plan = periods.load_plan(
        periods.with_months(municipalities, *periods.recurring_range(today))
    )
    loads = events.where("event_type = 'view'").select(
        F.when(F.col("event_id") % 2 == 0, EXPENSES).otherwise(REVENUES).alias("dataset"),
        municipality.alias("municipality"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.lit("success").alias("status"),
    )
    return periods.missing_periods(plan, loads)


@_query(
    sql(
        """select max(completed_at_utc) as last_extraction_at, count(*) as calls,
          count(*) filter (status = 'success') as calls_success,
          count(*) filter (status = 'empty') as calls_empty,
          count(*) filter (status = 'failed') as calls_failed,
          cast(sum(record_count) as bigint) as records_processed,
          cast(sum(epoch_us(completed_at_utc) - epoch_us(started_at_utc)) as double) / count(*) / 1e6
            as mean_duration_seconds
        from ing_runs""",
        "ing_runs",
    )
)
def ops_monitoring(spark, sf):
    return runs.extraction_indicators(_ingestion(spark, sf).runs)


@_query(
    sql(
        """select run_id, status, dry_run, completed_at_utc, duration_seconds, failed_stage
        from full_runs
        qualify row_number() over (order by completed_at_utc desc, manifest_line_number desc) = 1""",
        "full_runs",
    )
)
def ops_last_full_run(spark, sf):
    return runs.last_full_run(manifests.parse_full_runs(S.full_run_lines(spark, sf)).runs)


@_query(
    sql("select status, dry_run, count(*) as runs from full_runs group by 1, 2", "full_runs")
)
def ops_full_run_summary(spark, sf):
    return runs.full_run_summary(manifests.parse_full_runs(S.full_run_lines(spark, sf)).runs)


@_query(
    sql(
        """select * exclude (manifest_line_number), row_number() over (
          partition by dry_run order by manifest_line_number) as manifest_line_number
        from full_runs""",
        "full_runs",
    )
)
def full_run_append(spark, sf):
    """Run records appended to two folders by many tasks; lines are numbered within a folder."""
    parsed = manifests.parse_full_runs(S.full_run_lines(spark, sf)).runs
    path = scratch_path(spark, "full-runs")
    as_text = {
        name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        for name in ("started_at_utc", "completed_at_utc")
    }
    records = parsed.withColumns(as_text)
    for dry in (True, False):
        ordered = records.where(F.col("dry_run") == dry).repartitionByRange("manifest_line_number")
        ordered = ordered.sortWithinPartitions("manifest_line_number").drop("manifest_line_number")
        landing.append_full_runs(ordered, f"{path}/dry={dry}")
    return _numbered_on(manifests.read_full_runs(spark, f"{path}/dry=*")).drop("manifest_folder")


def _numbered_on(found: DataFrame) -> DataFrame:
    """Line numbers that go on over a folder's files, in the order of their names.

    Files come from sorted ranges; the window runs over files, not lines.
    """
    folder = F.regexp_extract("manifest_file", "^(.*)/[^/]+$", 1).alias("manifest_folder")
    files = found.groupBy(folder, "manifest_file").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("manifest_folder").orderBy("manifest_file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("manifest_folder", "manifest_file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return (
        found.join(before, "manifest_file")
        .withColumn("manifest_line_number", F.col("manifest_line_number") + F.col("before"))
        .drop("manifest_file", "before")
    )


@_query(
    sql(
        """select * exclude (manifest_line_number, month), month, month as file_month, row_number() over (
          partition by month order by manifest_line_number) as manifest_line_number
        from ing_runs""",
        "ing_runs",
    )
)
def ingestion_runs_from_files(spark, sf):
    """Usable manifest lines in a folder for each month, read by the strict reader."""
    parsed = _ingestion(spark, sf).runs.select("month", F.col("manifest_line_number").alias("line_number"))
    lines = S.ingestion_lines(spark, sf).join(parsed, "line_number")
    path = scratch_path(spark, "ingestion")
    (
        lines.select("month", "line_number", F.col("line").alias("value"))
        .repartitionByRange("month", "line_number")
        .sortWithinPartitions("month", "line_number")
        .drop("line_number")
        .write.partitionBy("month")
        .text(path)
    )
    found = manifests.read_ingestion_runs(spark, f"{path}/month=*")
    month = F.regexp_extract("manifest_folder", "month=([0-9]+)", 1).cast("int")
    return _numbered_on(found).withColumn("file_month", month).drop("manifest_folder")


@_query(
    sql(
        """select case when r.manifest_line_number <= (select max(event_id) + 1 from events) // 2 then 1 else 2 end as read_no,
          run_id, status, dataset, municipality, year, month, record_count
        from ing_runs r""",
        "ing_runs",
    )
)
def manifest_tail(spark, sf):
    """Half of the manifest is read, the rest arrives in further files and is read on its own."""
    path, state = scratch_path(spark, "manifest"), scratch_path(spark, "manifest-state")
    lines = S.ingestion_lines(spark, sf)
    middle = F.lit(S.table(spark, sf, "events").agg(F.max("event_id") + 1).first()[0] // 2)
    found = []
    for read_no, rows_ in enumerate((F.col("line_number") <= middle, F.col("line_number") > middle), start=1):
        arrived = lines.where(rows_).repartitionByRange("line_number").sortWithinPartitions("line_number")
        target = f"{path}/part={read_no}"
        arrived.select(F.col("line").alias("value")).write.text(target)
        read = tail.read_tail(spark, path, state, manifests.parse_ingestion_runs)
        found.append(read.parsed.runs.withColumn("read_no", F.lit(read_no)))
        read.commit()
    return found[0].unionByName(found[1]).select(
        "read_no", "run_id", "status", "dataset", "municipality", "year", "month", "record_count"
    )


# ---- refresh by month -------------------------------------------------------------

_NEWER = "20240201T000000Z"


def _landed_month() -> Column:
    return F.col("mes_particao")


def _expense_changes(records: DataFrame) -> DataFrame:
    """March without commitments, April with new names, no December."""
    renamed = F.when(_landed_month() == 4, F.concat("nm_fornecedor", F.lit(" NOVO"))).otherwise(F.col("nm_fornecedor"))
    kept = _landed_month().isin(3, 4) & ~((_landed_month() == 3) & (F.col("evento") == "Empenhado"))
    return records.where(kept).withColumn("nm_fornecedor", renamed)


def _revenue_changes(records: DataFrame) -> DataFrame:
    """March without one source, April of another organisation, no December."""
    moved = F.when(_landed_month() == 4, F.lit("ORGAO NOVO")).otherwise(F.col("orgao"))
    kept = _landed_month().isin(3, 4) & ~((_landed_month() == 3) & (F.col("ds_fonte_recurso") == "01 - TESOURO"))
    return records.where(kept).withColumn("orgao", moved)


def _arrivals(spark, sf, dataset: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All records of a dataset, the newer ones of some months, and these months.

    They are landed, so no model's filter meets them: only what is landed is derived.
    """
    if dataset == EXPENSES:
        records, change = _orders_as_records(spark, sf), _expense_changes
    else:
        records, change = S.revenue_records(S.table(spark, sf, "lineitem")), _revenue_changes
    return records, change(records), records.where(_landed_month().isin(3, 4, 12)).select(*snapshots.PARTITION)


def _refreshed(spark, sf, dataset: str) -> months.MonthLake:
    """Built from one set of snapshots, then refreshed by newer ones of three months."""
    root = scratch_path(spark, "bronze")
    refreshed = months.MonthLake(spark, scratch_path(spark, "lake"))
    records, newer, planned = _arrivals(spark, sf, dataset)
    for rows_, stamp, plan in ((records, S.STAMP, None), (newer, _NEWER, planned)):
        landing.write_snapshots(rows_, root, dataset, stamp, plan)
        found = months.pending(refreshed, dataset, snapshots.list_files(spark, root, dataset))
        months.apply_changes(refreshed, {dataset: found})
    return refreshed


@_query(rows("f_exp_new"))
def month_replacement(spark, sf):
    """The expense fact after a refresh that corrects two months and empties one."""
    return _refreshed(spark, sf, EXPENSES).read("fct_despesas")


@_query(rows("f_rev_new"))
def month_replacement_revenue(spark, sf):
    """The revenue fact after such a refresh: only changed fingerprints are numbered anew."""
    return _refreshed(spark, sf, REVENUES).read("fct_receitas")


@_query(rows("d_sup_new"))
def month_replacement_supplier(spark, sf):
    """Suppliers from counted names by month, after names were corrected and taken back."""
    return _refreshed(spark, sf, EXPENSES).read("dim_fornecedor")


@_query(
    sql(
        """select 'despesas' as "table", despesa_sk as sk from f_exp_new
        union all select 'receitas', receita_sk from f_rev_new
        union all select 'fornecedores', fornecedor_sk || '/' || nm_fornecedor_atual from d_sup_new""",
        "f_exp_new",
        "f_rev_new",
        "d_sup_new",
    )
)
def streaming_refresh(spark, sf):
    """Three batches of manifest rows, the last one applied twice; both datasets."""
    base, lake_root = scratch_path(spark, "bronze"), scratch_path(spark, "lake")
    manifest = f"{base}/manifest"
    streamed = months.MonthLake(spark, lake_root)
    datasets = {d: _arrivals(spark, sf, d) for d in (EXPENSES, REVENUES)}

    def step(land: Callable) -> None:
        for dataset, arrived in datasets.items():
            land(dataset, *arrived)
        refresh.start_refresh(streamed, manifest, f"{lake_root}/checkpoint").awaitTermination()

    def half(months_: Column, stamp: str) -> Callable:
        return lambda d, rows_, newer, planned: landing.land(
            rows_.where(months_), base, manifest, d, planned=rows_.where(months_), stamp=stamp
        )

    step(half(_landed_month() <= 6, S.STAMP))
    step(half(_landed_month() > 6, "20240101T000001Z"))
    step(lambda d, rows_, newer, planned: landing.land(newer, base, manifest, d, planned=planned, stamp=_NEWER))
    # Spark repeats a batch whose commit it does not find
    refresh.apply_batch(streamed, "refresh", None, spark.read.text(manifest), 2)
    supplier = F.concat_ws("/", "fornecedor_sk", "nm_fornecedor_atual")
    parts = (("fct_despesas", F.col("despesa_sk")), ("fct_receitas", F.col("receita_sk")), ("dim_fornecedor", supplier))
    found = [
        streamed.read(t).select(F.lit(n).alias("table"), key.alias("sk"))
        for (t, key), n in zip(parts, ("despesas", "receitas", "fornecedores"))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


@_query(
    sql(
        """select * exclude (arquivo_origem) from stg_exp where mes <> 4
        union all select * exclude (arquivo_origem) from stg_exp where mes = 4 and evento = 'Valor Pago'""",
        "stg_exp",
    )
)
def committed_rows(spark, sf):
    """A newer stamp is finished for April and half-written for May: May stays as it was."""
    base = scratch_path(spark, "landed")
    manifest, records = f"{base}/manifest", S.as_parsed(_orders_as_records(spark, sf))
    landing.land(records, base, manifest, EXPENSES, planned=records, stamp=S.STAMP)
    april = records.where((_landed_month() == 4) & (F.col("evento") == "Valor Pago"))
    landing.land(april, base, manifest, EXPENSES, planned=records.where(_landed_month() == 4), stamp="20240201T000000Z")
    landing.write_snapshots(records.where((_landed_month() == 5) & (F.col("o_orderkey") % 2 == 0)), base, EXPENSES, "20240301T000000Z")
    finished = manifests.read_ingestion_runs(spark, manifest)
    return silver_expenses(snapshots.read_latest(spark, base, EXPENSES, runs=finished)).drop(SOURCE_PATH)


# ---- serving ---------------------------------------------------------------------

@_query(rows("full_runs"))
def publish_ops_runs(spark, sf):
    """Run records, published as a table and read back."""
    parsed = manifests.parse_full_runs(S.full_run_lines(spark, sf)).runs
    root = scratch_path(spark, "published")
    publish.publish(spark, {"ops.pipeline_runs": parsed}, root)
    return publish.read_published(spark, root, "ops.pipeline_runs")


@_query(rows("ing_runs"))
def publish_ingestion_runs(spark, sf):
    """Typed ingestion runs, published as a table and read back."""
    root = scratch_path(spark, "published")
    publish.publish(spark, {"ops.ingestion_runs": _ingestion(spark, sf).runs}, root)
    return publish.read_published(spark, root, "ops.ingestion_runs")


@_query(
    sql(
        """select 'first' as version, * from f_exp
        union all select 'second', * replace (cast(case when exercicio = 1995 then vl_despesa + 1 else vl_despesa end as decimal(18,2)) as vl_despesa)
        from f_exp where exercicio <> 1996""",
        "f_exp",
    )
)
def publish_shared_files(spark, sf):
    """Two versions of the expense fact: the second one corrects a year and drops another."""
    root = scratch_path(spark, "published")
    fact = FC.fct_expense(S.expenses(spark, sf, whole=True))
    year = F.col("exercicio")
    raised = F.when(year == 1995, F.col("vl_despesa") + 1).otherwise(F.col("vl_despesa")).cast("decimal(18,2)")
    corrected = fact.where(year != 1996).withColumn("vl_despesa", raised)
    named = {n: versions.publish_version(spark, {"fct_despesas": df}, root) for n, df in (("first", fact), ("second", corrected))}
    found = [
        versions.read_version(spark, root, "fct_despesas", v).select(F.lit(n).alias("version"), *fact.columns)
        for n, v in named.items()
    ]
    return found[0].unionByName(found[1])


_GOLD_BLOCKS = {
    "dim_municipio": "d_mun",
    "dim_orgao": "d_org",
    "dim_tempo": "d_cal",
    "dim_fornecedor": "d_sup",
    "dim_fonte_recurso": "d_src",
    "dim_aplicacao": "d_app",
    "dim_alinea": "d_cls",
    "dim_subalinea": "d_sub",
    "fct_despesas": "f_exp",
    "fct_receitas": "f_rev",
}


@_query(
    sql(
        " union all ".join(f"""select '{t}' as "table", count(*) as rows from {b}""" for t, b in _GOLD_BLOCKS.items()),
        *_GOLD_BLOCKS.values(),
    )
)
def publish_counts(spark, sf):
    """All Gold tables, built from the given tables and published."""
    root = scratch_path(spark, "published")
    publish.publish_lake(_built_lake(spark, sf), root)
    return publish.published_counts(spark, root)


@_query(
    sql(
        """select receita_sk, despesas, exercicio, mes, valor from (
          select receita_sk, null::bigint as despesas, exercicio, mes, vl_arrecadacao as valor from f_rev
          union all select null, count(*), exercicio, mes, cast(sum(vl_despesa) as decimal(18,2)) from f_exp group by all)""",
        "f_exp",
        "f_rev",
    )
)
def publish_gold(spark, sf):
    """Contents of the two published facts, read by year."""
    root = scratch_path(spark, "published")
    publish.publish_lake(_built_lake(spark, sf), root)
    revenues = publish.read_published(spark, root, "fct_receitas")
    expenses = publish.read_published(spark, root, "fct_despesas")
    return revenues.select(
        "receita_sk", F.lit(None).cast("bigint").alias("despesas"), "exercicio", "mes", F.col("vl_arrecadacao").alias("valor")
    ).union(
        expenses.groupBy("exercicio", "mes").agg(
            F.count(F.lit(1)).alias("despesas"), F.sum("vl_despesa").cast("decimal(18,2)").alias("valor")
        ).select(F.lit(None).cast("string"), "despesas", "exercicio", "mes", "valor")
    )


@_query(
    sql(
        """select municipio, exercicio, mes, receita, despesa, saldo,
          cast(sum(saldo) over (partition by municipio, exercicio order by mes
            rows unbounded preceding) as decimal(28,2)) as saldo_acumulado
        from (select municipio, exercicio, mes, cast(sum(r) as decimal(28,2)) as receita,
                cast(sum(d) as decimal(28,2)) as despesa,
                cast(sum(r) - sum(d) as decimal(28,2)) as saldo
              from (select municipio, exercicio, mes, vl_arrecadacao as r, 0 as d from stg_rev
                    union all select municipio, exercicio, mes, 0, vl_despesa from stg_exp
                    where evento = 'Valor Pago')
              group by all)""",
        "stg_exp",
        "stg_rev",
    )
)
def exec_monthly_balance(spark, sf):
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    found = indicators.monthly_balance(
        FC.fct_expense(S.expenses(spark, sf, whole=True)),
        FC.fct_revenue(S.revenues(spark, sf, whole=True)),
        D.dim_municipality(exp, rev),
    )
    return _decimals(found, "receita", "despesa", "saldo", "saldo_acumulado")


@_query(
    sql(
        """select municipio, orgao as nm_orgao, count(*) as lancamentos,
          cast(sum(vl_despesa) as decimal(28,2)) as valor
        from stg_exp where evento = 'Valor Pago' group by all""",
        "stg_exp",
    )
)
def exec_by_organisation(spark, sf):
    exp, rev = S.expenses(spark, sf), S.revenues(spark, sf)
    fact = FC.fct_expense(S.expenses(spark, sf, whole=True))
    found = indicators.expense_by_organisation(fact, D.dim_organisation(exp, rev))
    return _decimals(found, "valor")


@_query(
    sql(
        """select s.fornecedor_bk, s.nm_fornecedor_atual, s.tipo_fornecedor,
          count(*) as lancamentos, cast(sum(f.vl_despesa) as decimal(28,2)) as valor
        from f_exp f join d_sup s using (fornecedor_sk)
        where f.evento = 'Valor Pago' group by all""",
        "f_exp",
        "d_sup",
    )
)
def exec_top_entities(spark, sf):
    fact = FC.fct_expense(S.expenses(spark, sf, whole=True))
    found = indicators.expense_by_supplier(fact, D.dim_supplier(S.expenses(spark, sf)))
    return _decimals(found, "valor").orderBy(F.desc("valor"), "fornecedor_bk")


@_query(
    sql(
        """select s.fornecedor_bk, s.nm_fornecedor_atual, s.tipo_fornecedor,
          count(*) as lancamentos, cast(sum(f.vl_despesa) as decimal(28,2)) as valor
        from f_exp f join d_sup s using (fornecedor_sk)
        where f.evento = 'Valor Pago' group by all""",
        "f_exp",
        "d_sup",
    )
)
def exec_top_entities_by_name(spark, sf):
    """The same from catalog tables, bucketed by supplier: the fact is not moved."""
    prefix = f"lake_{uuid.uuid4().hex[:8]}_"
    expenses = S.expenses(spark, sf, whole=True)
    catalog.register(spark, "fct_despesas", FC.fct_expense(expenses), prefix)
    catalog.register(spark, "dim_fornecedor", D.dim_supplier(expenses), prefix)
    found = indicators.expense_by_supplier(
        catalog.read(spark, "fct_despesas", prefix), catalog.read(spark, "dim_fornecedor", prefix)
    )
    return _decimals(found, "valor")


@_query(
    sql(
        """select cd_fonte_recurso, nm_fonte_recurso, exercicio, count(*) as lancamentos,
          cast(sum(vl_arrecadacao) as decimal(28,2)) as valor
        from stg_rev join d_src using (ds_fonte_recurso) group by all""",
        "stg_rev",
        "d_src",
    )
)
def exec_revenue_by_source(spark, sf):
    fact = FC.fct_revenue(S.revenues(spark, sf, whole=True))
    found = indicators.revenue_by_source(fact, D.dim_source(S.revenues(spark, sf)))
    return _decimals(found, "valor")


@_query(
    sql(
        """select evento, tempo_sk, count(*) as lancamentos,
          cast(sum(vl_despesa) as decimal(28,2)) as valor from f_exp group by all""",
        "f_exp",
    )
)
def expense_by_event_and_month(spark, sf):
    """The flagship question: records to Silver to fact, totals per event and month."""
    found = indicators.event_totals(FC.fct_expense(S.expenses(spark, sf, whole=True)), "tempo_sk")
    return _decimals(found, "valor")


def queries() -> dict[str, Query]:
    return {name: run for name, (run, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in _QUERIES.items() if text is not None}
