"""Duplicates: keep the last or the first row of a key.

None of these buffers the rows of a key in one task. Row choice is an aggregate with map-side combine, so a key that
holds a third of the table shrinks to one row per map task before the shuffle. ``mark_last`` on a numeric ordinal is a
hash aggregate; ``keep_last`` and ``keep_first`` carry whole rows, for which Spark sorts each partition by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_last(df: DataFrame, key: Sequence[str], ordinal: str, eligible: str, marker: str = "_is_last") -> DataFrame:
    """Flag the row with the highest ordinal of each key among the eligible rows; keep all rows.

    The rows are joined back on key *and* ordinal. The ordinal is unique, so this join spreads evenly
    whatever the key distribution is, and rows without a key spread by their ordinal.
    """
    # A condition in the aggregate and no filter before it: a filter would be evaluated on the raw columns again.
    last = df.groupBy(*key).agg(F.max(F.when(F.col(eligible), F.col(ordinal))).alias("_last"))
    last = last.select(*[F.col(name).alias(f"_l_{name}") for name in key], "_last")
    same_row = F.col(ordinal) == F.col("_last")
    for name in key:
        same_row = same_row & (F.col(name) == F.col(f"_l_{name}"))
    joined = df.join(last, same_row, "left")
    flag = F.col(eligible) & F.col("_last").isNotNull()
    return joined.select(*df.columns, flag.alias(marker))


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest ``order`` tuple."""
    return _pick(df, key, F.max_by(F.struct(*df.columns), F.struct(*order)))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the lowest ``order`` tuple."""
    return _pick(df, key, F.min_by(F.struct(*df.columns), F.struct(*order)))


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows over the columns; null equals null."""
    return df.select(*columns).distinct()


def _pick(df: DataFrame, key: Sequence[str], chosen: Column) -> DataFrame:
    picked = df.groupBy(*key).agg(chosen.alias("_row"))
    return picked.select(*[F.col("_row")[name].alias(name) for name in df.columns])
