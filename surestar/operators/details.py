"""Detail tables rolled up to one row per parent. Spark combines on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_by_key(details: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    return details.groupBy(key).agg(F.sum(amount).alias(name))


def any_by_key(details: DataFrame, key: str, flag: Column, name: str) -> DataFrame:
    return details.groupBy(key).agg(F.bool_or(flag).alias(name))


def left_details(df: DataFrame, key: str, summed: DataFrame, summed_key: str, name: str) -> DataFrame:
    """Left join to a detail table that has one row per key; rows without details get null."""
    right = summed.select(F.col(summed_key).alias("_d"), F.col(name).alias("_v"))
    joined = df.join(right, F.col(key) == F.col("_d"), "left")
    return joined.select(*df.columns, F.col("_v").alias(name))
