"""Referential filters and markers.

Rows with a null reference would all hash to one partition. Where such rows are kept, they get a
private text that no parent has, so they spread over all partitions and still match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NO_MATCH = "\u0000"


def spread_nulls(key: Column, spread: Column) -> Column:
    """Replace a null text key by a private text made from ``spread``."""
    return F.coalesce(key, F.concat(F.lit(_NO_MATCH), spread.cast("string")))


def mark_parent(
    df: DataFrame, key: str, parents: DataFrame, parent_key: str, marker: str, spread: str | None = None
) -> DataFrame:
    """Add a boolean column that says whether the reference exists among the parents."""
    known = parents.select(F.col(parent_key).alias("_parent")).distinct()
    child = spread_nulls(F.col(key), F.col(spread)) if spread else F.col(key)
    joined = df.join(known, child == F.col("_parent"), "left")
    return joined.select(*df.columns, F.col("_parent").isNotNull().alias(marker))


def mark_parents(
    df: DataFrame, key: str, parents: Sequence[tuple[DataFrame, str, str]], spread: str | None = None
) -> DataFrame:
    """Several markers (parents, parent key, marker) for one reference by one join.

    The parents become one table of ids with a flag per kind, so a reference that most rows share is skewed in one
    join only, which Spark can split.
    """
    flags = [marker for _, _, marker in parents]
    union = None
    for table, parent_key, own in parents:
        part = table.select(F.col(parent_key).alias("_parent"), *[F.lit(flag == own).alias(f"_f_{flag}") for flag in flags])
        union = part if union is None else union.unionByName(part)
    known = union.groupBy("_parent").agg(*[F.bool_or(f"_f_{flag}").alias(f"_f_{flag}") for flag in flags])
    child = spread_nulls(F.col(key), F.col(spread)) if spread else F.col(key)
    joined = df.join(known, child == F.col("_parent"), "left")
    return joined.select(*df.columns, *[F.coalesce(f"_f_{flag}", F.lit(False)).alias(flag) for flag in flags])


def mark_all(
    df: DataFrame,
    ordinal: str,
    references: Sequence[tuple[str, DataFrame, str, str]],
    last_of: tuple[str, str, str] | None = None,
) -> DataFrame:
    """One marker per (child key, parents, parent key, marker), and for ``last_of`` (key, eligible, marker) whether a row is the last eligible one
    of its key, by one join with what is known and one join back.

    All references of a row are turned into rows (ordinal, kind, id), which meet one table of the ids of all kinds of parents. The highest
    eligible ordinal of a key names its last row, so it is found without a join. What is found is one number of flags per
    ordinal. Only the ordinal and the ids are moved on the way; null references are not moved at all.
    """
    kinds = list(dict.fromkeys(child for child, *_ in references))
    markers = [marker for *_, marker in references]
    known = None
    for bit, (child, parents, key, _) in enumerate(references):
        part = parents.select(F.lit(kinds.index(child)).alias("_kind"), F.col(key).alias("_id"), F.lit(1 << bit).alias("_flags"))
        known = part if known is None else known.unionByName(part)
    known = known.where("_id is not null").groupBy("_kind", "_id").agg(F.bit_or("_flags").alias("_flags"))
    looked_up = [F.struct(F.lit(k).alias("_kind"), F.col(c).alias("_id")) for k, c in enumerate(kinds)]
    asked = df.select(F.col(ordinal).alias("_of"), F.inline(F.array(*looked_up))).where("_id is not null")
    found = asked.join(known, ["_kind", "_id"]).select("_of", "_flags")
    if last_of:
        key, eligible, marker = last_of
        last = F.max(F.when(F.col(eligible), F.col(ordinal))).alias("_of")
        lasts = df.groupBy(key).agg(last).where("_of is not null")
        found = found.unionByName(lasts.select("_of", F.lit(1 << len(markers)).alias("_flags")))
        markers.append(marker)
    found = found.groupBy("_of").agg(F.bit_or("_flags").alias("_flags"))
    joined = df.join(found, F.col(ordinal) == F.col("_of"), "left")
    flags = F.coalesce("_flags", F.lit(0))
    return joined.select(*df.columns, *[(flags.bitwiseAND(F.lit(1 << bit)) != 0).alias(m) for bit, m in enumerate(markers)])


def semi(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference exists."""
    known = parents.select(F.col(parent_key).alias("_parent"))
    return df.join(known, F.col(key) == F.col("_parent"), "left_semi")


def semi_or_null(df: DataFrame, key: str, parents: DataFrame, parent_key: str, spread: str) -> DataFrame:
    """Rows whose reference is null or exists."""
    marked = mark_parent(df, key, parents, parent_key, "_found", spread)
    return marked.where(F.col("_found") | F.col(key).isNull()).drop("_found")


def anti_key(df: DataFrame, key: str, existing: DataFrame) -> DataFrame:
    """Rows whose key does not exist yet; rows without a key stay.

    A plain equality on one column: a table that is bucketed by it is not moved.
    """
    seen = existing.select(F.col(key).alias("_seen"))
    return df.join(seen, F.col(key) == F.col("_seen"), "left_anti")


def anti(df: DataFrame, keys: Sequence[str], existing: DataFrame) -> DataFrame:
    """Rows whose key tuple does not exist yet; null equals null."""
    seen = existing.select(*[F.col(name).alias(f"_seen_{name}") for name in keys])
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"_seen_{name}"))
    return df.join(seen, same, "left_anti")
