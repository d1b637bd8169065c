"""Column expressions, compared with the oracle engine where the two engines differ."""

from datetime import date
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from fiscalake.functions import keys, parse, paths, text


def evaluate(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def oracle(values, expression):
    con = duckdb.connect()
    return [con.execute(f"select {expression}", [v]).fetchall()[0][0] for v in values]


def test_trim_strips_every_space_separator_and_nothing_else(spark):
    values = [f"{chr(c)}a{chr(c)}" for c in (0x20, 0xA0, 0x1680, 0x2003, 0x202F, 0x3000, 0x9, 0xA)]
    assert evaluate(spark, values, text.trim_spaces) == oracle(values, "trim($1)")
    assert evaluate(spark, ["  x  "], text.trim_spaces) == ["x"]


def test_blank_and_filled(spark):
    values = [None, "", "  ", " ", "a"]
    assert evaluate(spark, values, text.is_blank) == [True, True, True, True, False]
    assert evaluate(spark, values, text.is_filled) == [False, False, False, False, True]
    assert evaluate(spark, values, text.blank_to_null) == [None, None, None, None, "a"]


def test_code_and_description(spark):
    values = ["1.1 - TAXA - LOCAL", "120", " - X", "A-1 - Z", None]
    assert evaluate(spark, values, text.code_part) == ["1.1", "120", None, "A-1", None]
    assert evaluate(spark, values, text.description_part) == [
        "TAXA - LOCAL",
        "120",
        "- X",
        "A-1 - Z",
        None,
    ]
    split = "nullif(trim(regexp_replace($1, '^[^-]+ - ', '')), '')"
    assert evaluate(spark, values, text.description_part) == oracle(values, split)


def test_month_number_is_exact_but_trimmed(spark):
    values = ["Janeiro", " Março ", "marco", "Marco", "DEZEMBRO", "Dezembro", "", None]
    assert evaluate(spark, values, parse.month_number) == [1, 3, None, None, None, 12, None, None]
    assert evaluate(spark, values, parse.exact_month_number)[1] is None


def test_money(spark):
    values = [
        "2.500,75", "1200,40", "1.200,40", "0,00", "-0,50", "abc", "", None, "1e3", "1,005",
        "12345678901234567,89", " 5,00 ", "1.234.567,8",
    ]
    sql = "try_cast(replace(replace(trim($1), '.', ''), ',', '.') as decimal(18,2))"
    got = evaluate(spark, values, parse.br_decimal)
    assert got == oracle(values, sql)
    assert got[:5] == [Decimal(x) for x in ("2500.75", "1200.40", "1200.40", "0.00", "-0.50")]


def test_dates(spark):
    values = [
        "09/01/2021", "4/1/2020", "30/02/2021", "29/02/2020", " 09/01/2021 ", "\t09/01/2021",
        "2021-01-09", "09/01/2021x", "009/01/2021", "09/01/12021", "", None,
    ]
    got = evaluate(spark, values, parse.br_date)
    assert got == oracle(values, "cast(try_strptime($1, '%d/%m/%Y') as date)")
    assert got[:2] == [date(2021, 1, 9), date(2020, 1, 4)]


def test_two_digit_years_stay_unparsed(spark):
    assert evaluate(spark, ["09/01/21"], parse.br_date) == [None]


@pytest.mark.parametrize(
    "identifier, expected",
    [
        ("CNPJ - 1", "CNPJ"),
        ("PESSOA FÍSICA - 5", "PESSOA FÍSICA"),
        ("IDENTIFICAÇÃO ESPECIAL - 1", "IDENTIFICAÇÃO ESPECIAL"),
        ("INSCRIÇÃO GENÉRICA", "INSCRIÇÃO GENÉRICA"),
        ("INTERNACIONAL - 9", "INTERNACIONAL"),
        ("CNPJ-1", "OUTRO"),
        ("RG - 1", "OUTRO"),
        (None, "OUTRO"),
    ],
)
def test_supplier_type(spark, identifier, expected):
    assert evaluate(spark, [identifier], keys.supplier_type) == [expected]


def test_supplier_key_adds_the_name_for_persons_only(spark):
    df = spark.createDataFrame(
        [("PESSOA FÍSICA - 5", "ANA"), ("PESSOA FÍSICA - 5", None), ("CNPJ - 1", "X"), (None, "Y")],
        "i string, n string",
    )
    got = [r[0] for r in df.select(keys.supplier_key(F.col("i"), F.col("n"))).collect()]
    assert got == ["PESSOA FÍSICA - 5||ANA", "PESSOA FÍSICA - 5", "CNPJ - 1", None]


def test_hashes_leave_nulls_out_and_match_the_oracle(spark):
    row = spark.sql(
        "select 'salto' a, cast(null as string) b, cast(-0.5 as decimal(18,2)) c, date'2021-01-09' d"
    )
    got = row.select(
        keys.hash_key(F.col("a"), F.col("b"), F.col("c"), F.col("d")),
        keys.hash_key(F.col("b")),
        keys.subclass_hash(F.lit("11 - TAXA")),
        keys.or_missing_member(keys.subclass_hash(F.col("b"))),
    ).first()
    want = duckdb.sql(
        """select md5(concat_ws('||', 'salto', null, cast(-0.5 as decimal(18,2))::varchar,
        '2021-01-09')), md5('SUBALINEA||' || '11 - TAXA')"""
    ).fetchall()[0]
    assert tuple(got) == (want[0], None, want[1], "-1")


def test_path_parts(spark):
    path = "s3://b/despesas/municipio=são-josé/exercicio=2021/mes=03/x_20210301T100000Z.json"
    part = "s3://b/d/municipio=a/exercicio=2021/mes=03/snapshot=20210301T100000Z/part-0.txt"
    df = spark.createDataFrame([(path,), (part,), ("elsewhere",)], "p string")
    p = F.col("p")
    rows = df.select(
        paths.path_municipality(p),
        paths.path_year(p),
        paths.path_month(p),
        paths.snapshot_name(p),
        paths.snapshot_stamp(paths.snapshot_name(p)),
    ).collect()
    assert tuple(rows[0]) == ("são-josé", 2021, 3, path, "20210301T100000Z")
    assert tuple(rows[1])[3:] == (part.rsplit("/", 1)[0], "20210301T100000Z")
    assert tuple(rows[2]) == ("", None, None, "elsewhere", "")
