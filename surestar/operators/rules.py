"""Row rules: every row carries the list of rules it breaks, found in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.functions.text import row_json

REASONS = "_reasons"
ROW_JSON = "_row_json"
KEPT = "_kept"


@dataclass(frozen=True)
class Rule:
    """A condition that good rows meet. A null outcome counts as broken."""

    name: str
    holds: Column


def reasons(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in the order of the rules."""
    broken = [F.when(~F.coalesce(rule.holds, F.lit(False)), rule.name) for rule in rules]
    if not broken:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*broken))


def with_reasons(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the broken rules and, as a flag that a Parquet scan can filter by, whether there are none."""
    return df.withColumn(REASONS, reasons(rules)).withColumn(KEPT, F.size(REASONS) == 0)


def kept(df: DataFrame) -> DataFrame:
    """Rows that break no rule, without the service columns."""
    good = df.where(F.col(KEPT))
    return good.select(*[name for name in df.columns if not name.startswith("_")])


def rejected(df: DataFrame, source: str, run_id: str) -> DataFrame:
    """Quarantine rows ``(source, reasons, row_json, run_id)``."""
    return df.where(~F.col(KEPT)).select(
        F.lit(source).alias("source"),
        F.col(REASONS).alias("reasons"),
        F.col(ROW_JSON).alias("row_json"),
        F.lit(run_id).alias("run_id"),
    )


def json_if_rejected(columns: Sequence[str]) -> Column:
    """The row as JSON, built only where a rule is broken."""
    return F.when(~F.col(KEPT), row_json(columns))
