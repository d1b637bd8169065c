"""Compare every registered query with its SQL on one data folder."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    return v.replace(tzinfo=None) if isinstance(v, datetime) else v


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_value(row[i])) for i in order) for row in rows)


_SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}


def _spark_type(t) -> str:
    text = t.simpleString()
    return _SPARK_TYPES.get(text, text.upper())


def compare(df, con, text: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty when equal."""
    got_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(text)
    want_cols, want_rows = rel.columns, rel.fetchall()
    problems = []
    if sorted(df.columns) != sorted(want_cols):
        return [f"columns {sorted(df.columns)} != {sorted(want_cols)}"]
    types = {f.name: _spark_type(f.dataType) for f in df.schema.fields}
    want_types = {n: str(t).replace(" ", "") for n, t in zip(want_cols, rel.types)}
    for name in types:
        if types[name] != want_types[name]:
            problems.append(f"type of {name}: {types[name]} != {want_types[name]}")
    got, want = _bag(df.columns, got_rows), _bag(want_cols, want_rows)
    if got != want:
        problems.append(
            f"rows {len(got_rows)} != {len(want_rows)}; only spark "
            f"{list((got - want).items())[:2]}; only sql {list((want - got).items())[:2]}"
        )
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from fiscalake.queries import registry
    from fiscalake.session import create_session

    spark = create_session(
        master="local[8]",
        extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = oracle_connection(sf_dir), registry.oracle_sql(), 0
    for name, run in registry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problems = compare(df, con, oracle[name]) if name in oracle else []
            note = "" if name in oracle else f"(no SQL, {df.count()} rows)"
        except Exception as error:  # report and go on to the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {note}")
        for problem in problems:
            print("     ", problem[:900])
    return bad


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    sys.exit(main(sys.argv[1], sys.argv[2:]))
