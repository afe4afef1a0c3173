"""The constraint report over the whole star: one row per rule with the number of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.operators import quality as q
from surestar.operators.rules import Rule
from surestar.plans import facts
from surestar.queries.base import Query
from surestar.queries.star import Star, sql_on_star
from surestar.schemas import CLAIM_KEYS, DIMENSIONS, FACTS, FOREIGN_KEYS, POLICY_KEYS, constraints
from surestar.session import materialise
from surestar.sources.audit import observe_rows

_NATURAL_KEYS = {
    "dim_agent": "agent_id", "dim_adjuster": "adjuster_id", "dim_item": "item_id", "dim_date": "date_id",
    "dim_plan": "plan_category", "dim_claim_type": "claim_type", "fact_policy": "policy_id", "fact_claim": "claim_id",
}


def star_tables(star: Star, rules: Mapping[str, Sequence[Rule]] | None = None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """All tables of the star, and the reports of the ``rules`` on facts.

    The facts are written once, with their amounts uncast, and their rules are counted meanwhile.
    """
    star.prepare(*DIMENSIONS)
    reports = []

    def written(name: str, df: DataFrame) -> DataFrame:
        checked = (rules or {}).get(name)
        if not checked:
            return materialise(df)
        df, seen = observe_rows(df, *q.rule_counters(checked))
        table = materialise(df)
        reports.append(q.counted_report(star.spark, name, checked, [q.violations(checked, seen.get)]))
        return table

    policies = written("fact_policy", star.checked_policies())
    ids = star.curated["claims"].select(F.col("id_parte").alias("claim_id"))
    claims = written("fact_claim", facts.number_new(star.new_claims(facts.as_stored(policies, "fact_policy")), "claim_id", ids=ids))
    return {**{name: star.dim(name) for name in DIMENSIONS}, "fact_policy": policies, "fact_claim": claims}, reports


def dq_rules(spark: SparkSession, d: str) -> DataFrame:
    """NOT NULL, range, domain, length and overflow rules; members with key -1 are exempt."""
    rules = {name: constraints(name, amount_order=True) for name in (*DIMENSIONS, *FACTS)}
    rules["fact_claim"] = [*rules["fact_claim"], Rule("open_date <= close_date", F.col("_dates_ok"))]
    tables, reports = star_tables(Star(spark, d), {name: rules[name] for name in FACTS})
    return q.combine([*[q.rule_report(name, tables[name].where("sk <> -1"), rules[name]) for name in DIMENSIONS], *reports])


def dq_foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    """Against parents that lack every tenth member."""
    tables, _ = star_tables(Star(spark, d))
    parents = {name: df.where("sk % 10 <> 3") for name, df in tables.items()}
    return q.combine([q.foreign_key_report(tables[fk.table], fk, parents[fk.parent]) for fk in FOREIGN_KEYS])


def dq_report(spark: SparkSession, d: str) -> DataFrame:
    """Uniqueness of keys in tables that hold some rows twice, missed lookups, null keys and overpaid claims."""
    tables, reports = star_tables(Star(spark, d), {
        "fact_policy": [*q.lookups_found(POLICY_KEYS), q.no_null_in([*POLICY_KEYS, "premium", "insured_sum"])],
        "fact_claim": [*q.lookups_found(CLAIM_KEYS), q.not_null("close_date_sk"), Rule("paid <= insured sum", ~facts.is_overpaid())],
    })
    twice = {name: df.unionByName(df.where("sk % 5 = 2")) for name, df in tables.items()}
    reports += [q.unique_report(name, df, "sk", *[k for k in [_NATURAL_KEYS.get(name)] if k]) for name, df in twice.items()]
    return q.combine(reports)


# The same as SQL text: (table, rule name, condition that a row has to meet).


def _null(table: str, *columns: str) -> list[tuple[str, str, str]]:
    return [(table, f"{c} not null", f"{c} IS NOT NULL") for c in columns]


def _length(table: str, **limits: int) -> list[tuple[str, str, str]]:
    return [(table, f"{c} length <= {n}", f"{c} IS NULL OR length({c}) <= {n}") for c, n in limits.items()]


def _money(table: str, *columns: str) -> list[tuple[str, str, str]]:
    return [(table, f"{c} fits decimal(12,2)", f"{c} IS NULL OR try_cast({c} AS DECIMAL(12,2)) IS NOT NULL") for c in columns]


_RULES = [
    *_length("dim_location", country=100, province=100, city=100),
    *_length("dim_person", person_id=20, occupation=40, sex=1), *_null("dim_person", "segment", "sex", "valid_from"),
    ("dim_person", "segment in domain", "segment IS NULL OR segment IN ('Joven', 'Adulto', 'Mayor')"),
    ("dim_person", "sex in domain", "sex IS NULL OR sex IN ('M', 'F', 'O')"),
    *_length("dim_item", item_id=20, item_type=50), *_money("dim_item", "item_value"),
    *_length("dim_agent", agent_id=20, agent_name=100),
    *_null("dim_plan", "plan_category"),
    ("dim_plan", "plan_category in domain", "plan_category IN ('Basico', 'Estandar', 'Premium')"),
    ("dim_date", "day in 1..31", "day BETWEEN 1 AND 31"), ("dim_date", "month in 1..12", "month BETWEEN 1 AND 12"),
    ("dim_date", "year in 2000..2100", "year BETWEEN 2000 AND 2100"),
    *_length("dim_adjuster", adjuster_id=20, adjuster_name=100), *_length("dim_claim_type", claim_type=100),
    *_null("fact_policy", *POLICY_KEYS, "premium", "insured_sum"), *_length("fact_policy", policy_id=20),
    ("fact_policy", "premium > 0", "premium IS NULL OR premium > 0"),
    ("fact_policy", "insured_sum > 0", "insured_sum IS NULL OR insured_sum > 0"),
    *_money("fact_policy", "premium", "insured_sum"),
    *_null("fact_claim", *CLAIM_KEYS, "claimed", "assessed", "paid"), *_length("fact_claim", claim_id=20),
    *_money("fact_claim", "claimed", "assessed", "paid"),
    ("fact_claim", "claimed >= assessed >= paid >= 0", "claimed >= assessed AND assessed >= paid AND paid >= 0"),
    ("fact_claim", "open_date <= close_date",
     "close_date_sk IS NULL OR (SELECT a.date_id <= z.date_id FROM dim_date a, dim_date z "
     "WHERE a.sk = open_date_sk AND z.sk = close_date_sk)"),
]


# Rules on facts look at the amounts before they are cast.
_CHECKED = {"fact_policy": "checked_policy", "fact_claim": "checked_claim"}


def _count(table: str, name: str, holds: str, where: str = "sk <> -1") -> str:
    return (
        f"SELECT '{table}: {name}' AS rule, count_if(NOT coalesce({holds}, false))::BIGINT AS violations "
        f"FROM {_CHECKED.get(table, table)} WHERE {where}"
    )


def _orphans(table: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{table}.{column}->{parent} exists' AS rule, count(*) AS violations FROM {table} c "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.sk = c.{column} AND p.sk % 10 <> 3)"
    )


def _repeated(table: str, column: str) -> str:
    return (
        f"SELECT '{table}: {column} unique' AS rule, count(*) AS violations FROM "
        f"(SELECT {column} FROM (SELECT {column} FROM {table} UNION ALL SELECT {column} FROM {table} WHERE sk % 5 = 2) "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _missed(table: str, columns: tuple[str, ...]) -> list[str]:
    return [_count(table, f"{c} found", f"{c} IS NULL OR {c} <> -1", "true") for c in columns]


_ANY_NULL = " AND ".join(f"{c} IS NOT NULL" for c in (*POLICY_KEYS, "premium", "insured_sum"))
_ALL_TABLES = [*DIMENSIONS, "fact_policy", "fact_claim"]

QUERIES = {
    "dq_rules": Query(dq_rules, sql_on_star(" UNION ALL ".join(_count(*rule) for rule in _RULES))),
    "dq_foreign_keys": Query(
        dq_foreign_keys, sql_on_star(" UNION ALL ".join(_orphans(k.table, k.column, k.parent) for k in FOREIGN_KEYS))
    ),
    "dq_report": Query(
        dq_report,
        sql_on_star(" UNION ALL ".join([
            *[_repeated(table, "sk") for table in _ALL_TABLES],
            *[_repeated(table, key) for table, key in _NATURAL_KEYS.items()],
            *_missed("fact_policy", POLICY_KEYS), *_missed("fact_claim", CLAIM_KEYS),
            _count("fact_policy", "any key null", _ANY_NULL, "true"),
            _count("fact_claim", "close_date_sk not null", "close_date_sk IS NOT NULL", "true"),
            "SELECT 'fact_claim: paid <= insured sum' AS rule, "
            "count_if(coalesce(paid > policy_insured_sum, false))::BIGINT AS violations FROM claim_rows",
        ])),
    ),
}
