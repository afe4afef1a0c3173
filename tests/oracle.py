"""Run a query here and its SQL in DuckDB on the same files and compare columns, types and rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

from surestar.queries.base import TABLES

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "DOUBLE": "double", "TIMESTAMP": "timestamp",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in (*TABLES, "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(x):
    if isinstance(x, Decimal):
        return format(x, "f")
    if isinstance(x, dt.datetime):
        return x.isoformat()
    return x


def compare(spark, folder: str, query) -> list[str]:
    """Differences between both results; an empty list means they agree."""
    con = connect(folder)
    expected = con.execute(query.sql)
    kinds = {
        d[0]: KINDS.get(str(d[1]), str(d[1]).lower().replace(" ", "")) for d in expected.description
    }
    expected_names = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    df = query.run(spark, folder)
    actual_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    problems = []
    if sorted(kinds) != sorted(actual_kinds):
        return [f"columns {sorted(actual_kinds)} instead of {sorted(kinds)}"]
    for name in kinds:
        if kinds[name] != actual_kinds[name]:
            problems.append(f"type of {name}: {actual_kinds[name]} instead of {kinds[name]}")
    names = sorted(kinds)
    actual = Counter(tuple(_value(row[name]) for name in names) for row in df.collect())
    order = [expected_names.index(name) for name in names]
    wanted = Counter(tuple(_value(row[i]) for i in order) for row in expected_rows)
    if actual != wanted:
        extra, lacking = list((actual - wanted).elements()), list((wanted - actual).elements())
        problems.append(
            f"{sum(actual.values())} rows instead of {sum(wanted.values())}; {len(extra)} extra, {len(lacking)} "
            f"lacking; columns {names}; extra {str(sorted(extra, key=str)[:3])[:700]}; lacking {str(sorted(lacking, key=str)[:3])[:700]}"
        )
    return problems
