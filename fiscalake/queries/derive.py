"""Source-shaped rows derived from the given tables.

``orders`` plays the expense records, ``lineitem`` the revenue records and ``events``
the snapshot files and run manifests. Every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.functions.parse import month_name
from fiscalake.plans.silver import silver_expenses, silver_revenues

STAMP = "20240101T000000Z"
NBSP = "\u00a0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def snapshot_path(dataset: str, municipality: Column, year: Column, month: Column, stamp) -> Column:
    mm = _two_digits(month)
    return _text(
        f"bronze/{dataset}/municipio=", municipality, "/exercicio=", year, "/mes=", mm,
        f"/{dataset}_", municipality, "_", year, "_", mm, "_", stamp, ".json",
    )


def as_parsed(records: DataFrame) -> DataFrame:
    """Records leave a generator, as they do when a snapshot's JSON is parsed.

    Filters of a model that reads whole records then see plain columns, as they would
    on real snapshots, instead of being evaluated on the expressions that derive the
    records. Models that read few columns are better off without: it ends pruning.
    """
    return records.select(F.inline(F.array(F.struct(*records.columns))))


def br_money_text(amount: Column) -> Column:
    """DECIMAL(18,2) as Brazilian text with thousand separators."""
    return F.translate(F.format_number(amount.cast("decimal(18,2)"), 2), ",.", ".,")


def expense_records(orders: DataFrame) -> DataFrame:
    """Bronze expenses with the partition each record belongs to."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    municipality = _text("m", customer % 3)
    prefix = (
        F.when(customer % 6 == 0, F.lit("CNPJ - "))
        .when(customer % 6 == 1, F.lit("PESSOA FÍSICA - "))
        .when(customer % 6 == 2, F.lit("IDENTIFICAÇÃO ESPECIAL - "))
        .when(customer % 6 == 3, F.lit("INSCRIÇÃO GENÉRICA - "))
        .when(customer % 6 == 4, F.lit("INTERNACIONAL - "))
        .otherwise(F.lit("RG - "))
    )
    number = F.when(customer % 6 == 1, customer % 50).otherwise(customer)
    money = br_money_text(F.col("o_totalprice"))
    records = orders.select(
        "o_orderkey",
        municipality.alias("municipio"),
        year.alias("exercicio"),
        month.alias("mes_particao"),
        F.when(key % 7 == 0, _text(" ", F.col("o_orderpriority"), NBSP))
        .otherwise(F.col("o_orderpriority"))
        .alias("orgao"),
        month_name(month).alias("mes"),
        F.when(F.col("o_orderstatus") == "O", F.lit("Empenhado"))
        .when(F.col("o_orderstatus") == "P", F.lit("Valor Pago"))
        .otherwise(F.lit("Valor Liquidado"))
        .alias("evento"),
        _text(key, "-", year).alias("nr_empenho"),
        _text(prefix, number).alias("id_fornecedor"),
        _text("FORNECEDOR ", customer, " ", key % 3).alias("nm_fornecedor"),
        F.when(key % 2 == 0, _text("1/1/", year)).otherwise(_text("01/01/", year)).alias(
            "dt_emissao_despesa"
        ),
        F.when(key % 11 == 0, _text("-", money)).otherwise(money).alias("vl_despesa"),
        snapshot_path("despesas", municipality, year, month, STAMP).alias("arquivo_origem"),
    )
    return records


def defective_expense_records(orders: DataFrame) -> DataFrame:
    """The same records with planted defects; some are repeated."""
    key = F.col("o_orderkey")

    def planted(column: str, every: int, value) -> Column:
        return F.when(key % every == 0, F.lit(value)).otherwise(F.col(column))

    other_month = F.regexp_replace("arquivo_origem", "mes=[0-9]{2}", "mes=13")
    defective = as_parsed(expense_records(orders)).withColumns(
        {
            "mes": planted("mes", 97, "Marco"),
            "vl_despesa": planted("vl_despesa", 101, "abc"),
            "dt_emissao_despesa": planted("dt_emissao_despesa", 103, "30/02/1999"),
            "evento": planted("evento", 89, "Outro evento"),
            "orgao": planted("orgao", 83, "  "),
            "id_fornecedor": planted("id_fornecedor", 79, None),
            "nm_fornecedor": planted("nm_fornecedor", 71, None),
            "arquivo_origem": F.when(key % 73 == 0, other_month).otherwise(F.col("arquivo_origem")),
        }
    )
    record = F.struct(*defective.columns)
    return defective.select(
        F.inline(F.array_repeat(record, F.when(key % 29 == 0, 2).otherwise(1)))
    )


def revenue_records(lineitem: DataFrame, *kept: str) -> DataFrame:
    """Bronze revenues with coarse amounts, so that identical records occur."""
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    municipality = _text("m", F.col("l_suppkey") % 3)
    line, quantity = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    records = lineitem.select(
        *kept,
        municipality.alias("municipio"),
        year.alias("exercicio"),
        month.alias("mes_particao"),
        _text("ORGAO ", line % 2).alias("orgao"),
        month_name(month).alias("mes"),
        F.when(F.col("l_returnflag") == "A", F.lit("01 - TESOURO"))
        .when(F.col("l_returnflag") == "N", F.lit("02 - TRANSFERENCIAS - ESTADO"))
        .otherwise(F.lit("05 - FEDERAL"))
        .alias("ds_fonte_recurso"),
        F.when(F.col("l_linestatus") == "F", F.lit("110 - GERAL"))
        .otherwise(F.lit("120"))
        .alias("ds_cd_aplicacao_fixo"),
        _text("1.", line, " - ALINEA ", line, " - LOCAL").alias("ds_alinea"),
        F.when(quantity % 2 == 1, F.lit("  "))
        .otherwise(_text(quantity, " - SUBALINEA ", quantity))
        .alias("ds_subalinea"),
        br_money_text(F.col("l_quantity")).alias("vl_arrecadacao"),
        snapshot_path("receitas", municipality, year, month, STAMP).alias("arquivo_origem"),
    )
    return records


def defective_revenue_records(lineitem: DataFrame) -> DataFrame:
    """The same records, some with an unknown year or month or a blank or missing source."""
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    no_year = F.regexp_replace("arquivo_origem", "exercicio=[0-9]{4}", "exercicio=abc")
    records = lineitem.select(key.alias("k"), "*").transform(lambda df: revenue_records(df, "k"))
    return as_parsed(records).withColumns(
        {
            "mes": F.when(F.col("k") % 31 == 0, "Marco").otherwise(F.col("mes")),
            "ds_fonte_recurso": F.when(F.col("k") % 23 == 0, " ")
            .when(F.col("k") % 29 == 0, None)
            .otherwise(F.col("ds_fonte_recurso")),
            "arquivo_origem": F.when(F.col("k") % 37 == 0, no_year).otherwise(F.col("arquivo_origem")),
        }
    )


def defective_revenues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_revenues(defective_revenue_records(table(spark, sf_dir, "lineitem")))


def expenses(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Silver expenses; ``whole`` for models that read whole records."""
    records = expense_records(table(spark, sf_dir, "orders"))
    return silver_expenses(as_parsed(records) if whole else records)


def defective_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_expenses(defective_expense_records(table(spark, sf_dir, "orders")))


def revenues(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    records = revenue_records(table(spark, sf_dir, "lineitem"))
    return silver_revenues(as_parsed(records) if whole else records)


def _event_stamp(pattern: str) -> Column:
    return F.date_format(F.col("ts").cast("timestamp"), pattern)


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per event; a file with no records is an empty snapshot."""
    stamp = _event_stamp("yyyyMMdd'T'HHmmss'Z'")
    municipality = _text("m", F.col("user_id"))
    month = (F.col("event_id") % 12 + 1).cast("int")
    return table(spark, sf_dir, "events").select(
        snapshot_path("despesas", municipality, F.year("ts"), month, stamp).alias("path"),
        (F.col("event_id") % 4).cast("int").alias("records"),
    )


def _iso(shift: str, zone: str) -> Column:
    moment = F.expr(f"cast(ts as timestamp) + interval {shift}")
    return _text(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone)


def ingestion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest lines (line_number, line); some are unusable in different ways."""
    event, case = F.col("event_id"), F.col("event_id") % 13
    kind = F.col("event_type")
    status = (
        F.when(case == 1, "unknown")
        .when(kind == "error", "failed")
        .when(kind == "view", "empty")
        .otherwise("success")
    )
    dataset = F.when(event % 2 == 0, "despesas").otherwise("receitas")
    municipality = F.when(case == 2, "").otherwise(
        _text('"municipality":"m', F.col("user_id") % 5, '",')
    )
    year = F.when(case == 8, '"2024"').otherwise("2024")
    count = F.when(case == 7, "null").otherwise((event % 500).cast("string"))
    completed = F.when(case == 6, "null").otherwise(_text('"', _iso("2.5 seconds", "+00:00"), '"'))
    record = _text(
        '{"run_id":"r', event, '","status":"', status, '","dataset":"', dataset, '",', municipality,
        '"year":', year, ',"month":', event % 12 + 1, ',"source_url":null,"record_count":', count,
        ',"content_length_bytes":', event * 10, ',"sha256":null,"started_at_utc":"',
        _iso("0 seconds", "Z"), '","completed_at_utc":', completed, ',"extracted_at_utc":"',
        _iso("4.25 seconds", "Z"), '","output_path":null,"error_type":null,"error_message":null}',
    )
    line = (
        F.when(case == 3, F.lit('{"run_id": '))
        .when(case == 4, F.lit("   "))
        .when(case == 5, F.lit("[1, 2]"))
        .otherwise(record)
    )
    return table(spark, sf_dir, "events").select((event + 1).alias("line_number"), line.alias("line"))


def full_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, case = F.col("event_id"), F.col("event_id") % 17
    failed = F.col("event_type") == "error"
    status = F.when(case == 1, "stopped").when(failed, "failed").otherwise("success")
    dry_run = F.when(case == 2, '"false"').when(event % 3 == 0, "true").otherwise("false")
    duration = F.when(case == 3, "").otherwise(_text('"duration_seconds":', event % 90, ".5,"))
    stage = F.when(failed, _text('"stage_', event % 3, '"')).otherwise("null")
    record = _text(
        '{"run_id":"p', event, '","execution_source":"', F.col("event_type"), '","status":"',
        status, '","dry_run":', dry_run, ',"started_at_utc":"', _iso("0 seconds", "+00:00"),
        '","completed_at_utc":"', _iso("90 seconds", "+00:00"), '",', duration,
        '"failed_stage":', stage, ',"error_message":null}',
    )
    return table(spark, sf_dir, "events").select(
        (event + 1).alias("line_number"), F.when(case == 4, F.lit("")).otherwise(record).alias("line")
    )


def prop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, record): the JSON of each event; some records carry a further field."""
    props = F.col("props")
    longer = _text('{"extra": 1, ', F.substr(props, F.lit(2)))
    return table(spark, sf_dir, "events").select(
        _text("events_", F.col("user_id"), ".json").alias("file"),
        F.when(F.col("event_id") % 3 == 0, longer).otherwise(props).alias("record"),
    )
