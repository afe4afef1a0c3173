"""Surrogate-key lookups: left joins to a unique key table, -1 for a miss.

The physical join is left to Spark: a key table under the broadcast threshold is broadcast (Spark checks
the size), a larger one is joined by shuffle, where AQE splits the partitions of a hot key. Rows with a
null key are spread by a unique column so that they never pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.operators.refint import spread_nulls

UNKNOWN_SK = -1


def or_unknown(sk: Column) -> Column:
    return F.coalesce(sk, F.lit(UNKNOWN_SK).cast("bigint"))


def first_by_key(table: DataFrame, key: Sequence[str], sk: str) -> DataFrame:
    """Key table with the lowest surrogate key per natural key."""
    return table.groupBy(*key).agg(F.min(sk).alias(sk))


def last_by_key(table: DataFrame, key: Sequence[str], sk: str) -> DataFrame:
    """Key table with the highest surrogate key per natural key."""
    return table.groupBy(*key).agg(F.max(sk).alias(sk))


def lookup(
    df: DataFrame,
    key: Sequence[Column],
    table: DataFrame,
    table_key: Sequence[str],
    take: dict[str, str],
    default: int | None = UNKNOWN_SK,
    spread: str | None = None,
) -> DataFrame:
    """Left join to ``table`` (unique on ``table_key``) and add the columns named in ``take``.

    ``take`` maps a column of the table to its name in the result. ``default`` replaces a miss; ``None``
    leaves it null. ``spread`` names a unique column of ``df``; with it the first key has to be text.
    """
    left_keys = list(key)
    if spread:
        left_keys[0] = spread_nulls(left_keys[0], F.col(spread))
    left = df.withColumns({f"_k{i}": c for i, c in enumerate(left_keys)})
    right = table.select(
        *[F.col(name).alias(f"_t{i}") for i, name in enumerate(table_key)],
        *[F.col(source).alias(f"_v_{target}") for source, target in take.items()],
    )
    same = F.lit(True)
    for i in range(len(left_keys)):
        same = same & (F.col(f"_k{i}") == F.col(f"_t{i}"))
    joined = left.join(right, same, "left")
    values = []
    for target in take.values():
        value = F.col(f"_v_{target}")
        values.append((value if default is None else F.coalesce(value, F.lit(default))).alias(target))
    return joined.select(*df.columns, *values)
