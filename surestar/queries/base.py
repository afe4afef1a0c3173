"""What the operator queries share: table access, the registry entry and SQL building blocks.

The driver tables hold clean data, so the feeds of the insurer are stood in for by them and dirt is injected by
expressions on the keys. ``STANDINS`` holds those inputs as SQL that both engines read alike; everything after the
input is written twice, once with this package and once as plain SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2026, 6, 30)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def run_sql(spark: SparkSession, folder: str, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text in which ``{name}`` stands for a driver table or for one of the frames."""
    used = {name: table(spark, folder, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used, **frames)


def plain(text: str) -> str:
    """The same SQL text for the engine in which the tables are registered under their own names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def with_parts(body: str, parts: Mapping[str, str]) -> str:
    """Put common table expressions in front of a query."""
    listed = ",\n".join(f"{name} AS (\n{plain(text).strip()}\n)" for name, text in parts.items())
    return f"WITH {listed}\n{body.strip()}"


# SQL building blocks


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_canonical(x: str) -> str:
    return sql_trim(f"upper(replace(strip_accents({x}), 'ß', 'ss'))")


def sql_title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


def sql_junk(x: str) -> str:
    visible = f"replace(replace({x}, chr(8203), ''), chr(9), '')"
    undotted = sql_trim(f"regexp_replace({sql_trim(visible)}, '\\.+$', '')")
    tokens = "'-', '.', '..', '000', '999', '?', 'n/d', 's/d', 'test', 'xxx', 'pendiente', '', 'none', 'nan'"
    return f"CASE WHEN lower({undotted}) NOT IN ({tokens}) THEN {sql_title(undotted)} END"


def sql_number(x: str, kind: str = "DECIMAL(20,2)") -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match({sql_trim(x)}, '{pattern}') THEN try_cast({sql_trim(x)} AS {kind}) END"


def sql_number_or_0(x: str, kind: str = "DECIMAL(20,2)") -> str:
    return f"coalesce({sql_number(x, kind)}, 0)::{kind}"


def sql_integer_or_0(x: str) -> str:
    return f"coalesce(trunc({sql_number(x, 'DECIMAL(24,6)')})::BIGINT, 0)"


def sql_date(x: str) -> str:
    formats = (
        "['%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y/%m/%d', '%Y-%m-%d %H:%M', '%Y-%m-%d %H:%M:%S.%g', "
        "'%Y-%m-%dT%H:%M:%SZ', '%Y-%-m-%-d']"
    )
    return f"try_strptime({sql_trim(x)}, {formats})::DATE"


def sql_id(x: str) -> str:
    return f"nullif({sql_trim(x)}, '')"


def sql_reference(x: str) -> str:
    return f"CASE WHEN {sql_id(x)} NOT IN ('nan', 'None', '<NA>', 'NaN') THEN {sql_id(x)} END"


def sql_true(x: str) -> str:
    return f"coalesce(lower({sql_trim(x)}) IN ('true', '1'), false)"


def sql_date_key(x: str) -> str:
    return f"(year({x}) * 10000 + month({x}) * 100 + day({x}))::INT"


def sql_full_name(first: str, last: str) -> str:
    return f"nullif(trim(coalesce({last}, '') || ', ' || coalesce({first}, ''), ', '), '')"


def sql_plan(x: str) -> str:
    return (
        f"CASE WHEN upper({x}) = 'EXTENDIDA' THEN 'Estandar' WHEN upper({x}) = 'BASICA' THEN 'Basico' "
        f"WHEN upper({x}) = 'PREMIUM' THEN 'Premium' END"
    )


def sql_employment(x: str) -> str:
    c = sql_canonical(x)

    def any_of(*words: str) -> str:
        return " OR ".join(f"contains({c}, '{word}')" for word in words)

    return (
        f"CASE WHEN {any_of('UNEMPLOY', 'DESEMPL', 'SIN TRAB', 'DISABL', 'INACTIV')} THEN 'Desempleado' "
        f"WHEN {any_of('RETIRE', 'JUB')} THEN 'Jubilado' "
        f"WHEN {any_of('MEDIC', 'LICENCIA', 'LEAVE')} THEN 'Licencia medica' "
        f"WHEN {any_of('EMP', 'ACTIV')} THEN 'Empleado' ELSE 'Other' END"
    )


def sql_sex(x: str) -> str:
    c = sql_canonical(x)
    return (
        f"CASE WHEN {c} IN ('M', 'MASCULINO', 'HOMBRE', 'VARON') THEN 'M' "
        f"WHEN {c} IN ('F', 'FEMENINO', 'MUJER') THEN 'F' ELSE 'O' END"
    )


def sql_segment(age: str) -> str:
    return f"CASE WHEN {age} < 35 THEN 'Joven' WHEN {age} >= 60 THEN 'Mayor' WHEN {age} IS NOT NULL THEN 'Adulto' END"


def sql_reasons(*rules: tuple[str, str]) -> str:
    """Bar-joined names of the rules whose condition does not hold."""
    broken = ", ".join(f"CASE WHEN NOT coalesce({holds}, false) THEN '{name}' END" for name, holds in rules)
    return f"concat_ws('|', {broken})"
