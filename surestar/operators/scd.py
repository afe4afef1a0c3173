"""Dimension merges as set operations over immutable snapshots: old state and input in, new state out.

All natural keys are unique on the input side. Members that vanish from the input stay. Keys are never
renumbered: new members get keys after the highest one given out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.operators.keys import keys_in_order, max_key
from surestar.operators.lookup import UNKNOWN_SK
from surestar.operators.refint import anti

STATUS_NEW, STATUS_CHANGED, STATUS_SAME = "new", "changed", "same"


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True if at least one pair differs; null equals null."""
    result = F.lit(False)
    for old, new in pairs:
        result = result | ~old.eqNullSafe(new)
    return result


def _real(dimension: DataFrame, sk: str) -> DataFrame:
    return dimension.where(F.col(sk) != UNKNOWN_SK)


def scd1_pairs(existing: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str], sk: str) -> DataFrame:
    """Members on both sides: key, old and new attributes side by side, and whether they differ."""
    old = _real(existing, sk).select(sk, key, *[F.col(a).alias(f"{a}_old") for a in attrs])
    new = incoming.select(key, *[F.col(a).alias(f"{a}_new") for a in attrs])
    changed = differs([(F.col(f"{a}_old"), F.col(f"{a}_new")) for a in attrs])
    return old.join(new, key).withColumn("changed", changed)


def scd1_status(existing: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str], sk: str) -> DataFrame:
    """Every incoming key with ``new``, ``changed`` or ``same``."""
    old = _real(existing, sk).select(F.col(sk).alias("_sk"), key, *[F.col(a).alias(f"_old_{a}") for a in attrs])
    changed = differs([(F.col(f"_old_{a}"), F.col(a)) for a in attrs])
    status = F.when(F.col("_sk").isNull(), STATUS_NEW).when(changed, STATUS_CHANGED).otherwise(STATUS_SAME)
    return incoming.join(old, key, "left").select(key, status.alias("status"))


def scd1_merge(
    existing: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str], sk: str, highest: int | None = None
) -> DataFrame:
    """Overwrite the attributes of known members and append new ones.

    ``highest``, here and below, is the highest key given out so far; without it the existing keys are scanned for it.
    """
    fresh = incoming.select(key, *attrs, F.lit(True).alias("_found"))
    joined = existing.alias("old").join(fresh.alias("new"), key, "left")
    take_new = F.col("_found") & (F.col(sk) != UNKNOWN_SK)
    updated = joined.select(
        sk,
        key,
        *[F.when(take_new, F.col(f"new.{a}")).otherwise(F.col(f"old.{a}")).alias(a) for a in attrs],
    )
    return updated.unionByName(_new_members(existing, incoming.select(key, *attrs), [key], sk, highest))


def insert_new_members(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], sk: str, highest: int | None = None
) -> DataFrame:
    """Old state plus the members whose natural key is not known yet."""
    return existing.unionByName(_new_members(existing, incoming, key, sk, highest))


def _new_members(existing: DataFrame, incoming: DataFrame, key: Sequence[str], sk: str, highest: int | None) -> DataFrame:
    fresh = anti(incoming, key, _real(existing, sk))
    return keys_in_order(fresh, key, sk, max_key(existing, sk) if highest is None else highest)


def scd2_status(existing: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], sk: str) -> DataFrame:
    """Incoming rows with their status and the key of the version that is current now."""
    current = _real(existing, sk).where("is_current")
    current = current.select(F.col(sk).alias("_sk"), key, *[F.col(a).alias(f"_old_{a}") for a in tracked])
    changed = differs([(F.col(f"_old_{a}"), F.col(a)) for a in tracked])
    status = F.when(F.col("_sk").isNull(), STATUS_NEW).when(changed, STATUS_CHANGED).otherwise(STATUS_SAME)
    return incoming.join(current, key, "left").select(*incoming.columns, "_sk", status.alias("status"))


def scd2_merge(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: dt.date,
    sk: str,
    highest: int | None = None,
    latest: dt.date | None = None,
) -> DataFrame:
    """Close the current version of changed members and open a new one; open one for new members.

    ``existing`` holds ``sk``, ``key``, the columns of ``incoming``, ``valid_from``, ``valid_to`` and
    ``is_current``. Versions are half-open intervals: the end of one is the start of the next.
    A second run with the same input changes nothing. An ``as_of`` before the start of a known version is refused: it
    would close versions before they began. ``latest`` is the latest such start and belongs to ``highest``.
    """
    if highest is None:
        real = _real(existing, sk)
        latest, highest = real.agg(F.max("valid_from"), F.coalesce(F.max(F.when(F.col(sk) > 0, F.col(sk))), F.lit(0))).first()
    if latest is not None and as_of < latest:
        raise ValueError(f"as_of {as_of} is before {latest}, the start of a version that is known already")
    today = F.lit(as_of).cast("date")
    compared = scd2_status(existing, incoming, key, tracked, sk)
    to_close = compared.where(F.col("status") == STATUS_CHANGED)
    to_close = to_close.select(F.col("_sk").alias("_close"), F.lit(True).alias("_closing"))
    closing = F.coalesce(F.col("_closing"), F.lit(False))
    history = existing.join(to_close, F.col(sk) == F.col("_close"), "left").withColumns({
        "valid_to": F.when(closing, today).otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & ~closing,
    })
    to_open = compared.where(F.col("status") != STATUS_SAME).select(*incoming.columns)
    opened = keys_in_order(to_open, [key], sk, highest).withColumns({
        "valid_from": today,
        "valid_to": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    })
    return history.select(*existing.columns).unionByName(opened.select(*existing.columns))


def ensure_unknown_member(dimension: DataFrame, sk: str, values: Mapping[str, object]) -> DataFrame:
    """Add the member with key -1 unless it is there already."""
    there = dimension.where(F.col(sk) == UNKNOWN_SK).select((F.col(sk) - UNKNOWN_SK).alias("_there"))
    member = dimension.sparkSession.range(1).select("id", *[
        F.lit(UNKNOWN_SK if field.name == sk else values.get(field.name)).cast(field.dataType).alias(field.name)
        for field in dimension.schema.fields
    ])
    return dimension.unionByName(member.join(there, F.col("id") == F.col("_there"), "left_anti").drop("id"))
