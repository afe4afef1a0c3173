"""Constraint reports: one row per rule with the number of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.functions.parse import MONEY
from surestar.operators.rules import Rule

REPORT_COLUMNS = ("rule", "violations")


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str
    parent_key: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}->{self.parent}"


def not_null(column: str) -> Rule:
    return Rule(f"{column} not null", F.col(column).isNotNull())


def in_range(column: str, low: object, high: object) -> Rule:
    c = F.col(column)
    return Rule(f"{column} in {low}..{high}", c.isNull() | c.between(low, high))


def in_domain(column: str, values: Sequence[str]) -> Rule:
    c = F.col(column)
    return Rule(f"{column} in domain", c.isNull() | c.isin(*values))


def positive(column: str) -> Rule:
    c = F.col(column)
    return Rule(f"{column} > 0", c.isNull() | (c > 0))


def max_length(column: str, limit: int) -> Rule:
    c = F.col(column)
    return Rule(f"{column} length <= {limit}", c.isNull() | (F.char_length(c) <= limit))


def fits_money(column: str) -> Rule:
    c = F.col(column)
    return Rule(f"{column} fits {MONEY}", c.isNull() | c.try_cast(MONEY).isNotNull())


def in_order(first: str, second: str) -> Rule:
    a, b = F.col(first), F.col(second)
    return Rule(f"{first} <= {second}", a.isNull() | b.isNull() | (a <= b))


def descending(columns: Sequence[str], floor: int = 0) -> Rule:
    """Amounts that must not grow from left to right and must not fall below the floor."""
    holds: Column = F.col(columns[-1]) >= floor
    for bigger, smaller in zip(columns, columns[1:]):
        holds = holds & (F.col(bigger) >= F.col(smaller))
    return Rule(" >= ".join([*columns, str(floor)]), holds)


def rule_counters(rules: Sequence[Rule], where: Column | None = None) -> list[Column]:
    """Aggregates ``v0``, ``v1``, ... with the violations of each rule among the rows that ``where`` chooses.

    They serve a report, or an Observation on a write, so that a table needs no other pass for its rules.
    """
    chosen = F.lit(True) if where is None else where
    return [F.count_if(chosen & ~F.coalesce(rule.holds, F.lit(False))).alias(f"v{i}") for i, rule in enumerate(rules)]


def violations(rules: Sequence[Rule], counts: Mapping[str, object]) -> dict[str, int]:
    """Violations by rule name from what ``rule_counters`` have counted."""
    return {rule.name: int(counts[f"v{i}"]) for i, rule in enumerate(rules)}


def counted_report(spark: SparkSession, table: str, rules: Sequence[Rule], counts: Sequence[Mapping[str, int]]) -> DataFrame:
    """The report of ``rule_report`` from violations that were counted while the table, or each of its parts, was written."""
    found = [(f"{table}: {rule.name}", sum(c[rule.name] for c in counts)) for rule in rules]
    return spark.createDataFrame(found, "rule string, violations bigint")


def rule_report(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one table in one pass over it."""
    counts = df.agg(*rule_counters(rules))
    rows = F.array(*[
        F.struct(F.lit(f"{table}: {rule.name}").alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def foreign_key_report(df: DataFrame, key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Rows whose key has no parent.

    The child side is counted per key first, so a key shared by most rows is one row in the join.
    """
    used = df.where(F.col(key.column).isNotNull()).groupBy(F.col(key.column).alias("_key")).count()
    parents = parent.select(F.col(key.parent_key).alias("_parent"))
    orphans = used.join(parents, F.col("_key") == F.col("_parent"), "left_anti")
    return orphans.agg(
        F.lit(f"{key.name} exists").alias("rule"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("violations"),
    )


def unique_report(table: str, df: DataFrame, *columns: str) -> DataFrame:
    """Number of values of each key that occur more than once; all keys of a table in one pass and one shuffle, as they are typed."""
    groups = df.groupingSets([[c] for c in columns], *columns)
    repeated = groups.agg(F.grouping_id().alias("_set"), F.count("*").alias("count")).where("count > 1")
    # A grouping id has a bit for each column that a set leaves out, the first column's the highest.
    n = len(columns)
    sets = [2**n - 1 - 2 ** (n - 1 - i) for i in range(n)]
    counts = repeated.agg(*[F.count_if(F.col("_set") == key).alias(f"v{i}") for i, key in enumerate(sets)])
    rows = [F.struct(F.lit(f"{table}: {c} unique").alias("rule"), F.col(f"v{i}").alias("violations")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*rows)))


def new_key_counts(sk: str, highest: int) -> list[Column]:
    """Aggregates over the part of a run, taken while it is written: the keys above ``highest``, which are new, and the others."""
    new = F.when(F.col(sk) > highest, F.col(sk))
    return [
        F.count(new).alias("new_keys"), F.min(new).alias("least"), F.max(new).alias("highest"),
        F.sum(new.cast("decimal(38,0)")).alias("key_sum"),
    ]


def noted_keys(counts: Mapping[str, object], earlier: Mapping[str, object], highest: int) -> dict:
    """What is kept beside a part: its rows and the intervals of its keys. New keys fill one interval exactly or are noted as ``odd``;
    a repeated run keeps the intervals of its earlier part."""
    intervals = [list(x) for x in earlier.get("intervals", [])]
    n, least, most = counts["new_keys"], counts["least"], counts["highest"]
    odd = bool(n) and (most - least + 1 != n or 2 * int(counts["key_sum"]) != (least + most) * n)
    if n:
        intervals.append([least, most])
    top = max([most or 0, *(x[1] for x in intervals)])
    return {"rows": counts["rows_out"], "intervals": intervals, "highest": max(top, earlier.get("highest", 0)), "odd": odd}


def key_interval_report(spark: SparkSession, table: str, notes: Mapping[str, Mapping | None]) -> DataFrame:
    """Uniqueness and density of the keys of all runs from what was noted beside their parts; no row is read.

    Keys are unique if the intervals of the parts are disjoint and each was filled exactly. The counts are keys that lie in the intervals of
    two parts, keys without a row (a repeated run whose input has lost rows leaves such), and runs that can't be told from notes.
    """
    told = [n for n in notes.values() if n and "intervals" in n]
    intervals = sorted(tuple(x) for n in told for x in n["intervals"])
    shared, end = 0, 0
    for least, most in intervals:
        shared += max(0, min(end, most) - least + 1)
        end = max(end, most)
    missing = sum(most - least + 1 for least, most in intervals) - sum(n["rows"] for n in told)
    untold = len(notes) - sum(not n["odd"] for n in told)
    found = [("in two runs", shared), ("without a row", abs(missing)), ("of runs that are not known", untold)]
    return spark.createDataFrame([(f"{table}: keys {what}", int(n)) for what, n in found], "rule string, violations bigint")


def no_null_in(columns: Sequence[str]) -> Rule:
    """Broken by a null in at least one of the columns."""
    return Rule("any key null", reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns]))


def lookups_found(columns: Sequence[str]) -> list[Rule]:
    """Per key column, that it doesn't point at the unknown member."""
    return [Rule(f"{name} found", F.col(name).isNull() | (F.col(name) != -1)) for name in columns]


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)
