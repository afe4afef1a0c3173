"""Dense surrogate keys without a global sort in one task.

Both functions number the rows 1, 2, 3, ... after ``start``. Each cuts the rows into ordered buckets, numbers the
rows inside a bucket in parallel and adds the count of all earlier buckets. Only bucket counts, whose number is
bounded, ever meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surestar.session import materialise

HASH_DIGITS = 4  # 16**4 = 65,536 buckets: 1.5 million rows in each at 100 billion rows


def max_key(existing: DataFrame, sk: str) -> int:
    """Highest key given out so far, 0 if there is none. Key -1 is ignored. Scans the keys; prefer what was noted while writing."""
    return existing.where(F.col(sk) > 0).agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]


def keys_in_order(df: DataFrame, order: Sequence[str], sk: str, start: int = 0) -> DataFrame:
    """Number the rows in the order of their natural key, which has to be unique.

    The rows are range partitioned and sorted in their partitions. The range bounds come from a sample, so the result is
    written to the shared folder once and its partitions are counted there: a lost executor cannot make the counts
    and the rows disagree. The counts, one per partition, are joined back. For new dimension members, not for facts.
    """
    ascending = [F.asc_nulls_first(name) for name in order]
    placed = materialise(
        df.repartitionByRange(*ascending)
        .sortWithinPartitions(*ascending)
        .withColumns({
            "_bucket": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) + 1,
        })
    )
    counts = placed.groupBy("_bucket").agg(F.count("*").alias("count"))
    value = F.col("_offset") + F.col("_place") + F.lit(start)
    numbered = placed.join(_offsets(counts), "_bucket")
    return numbered.select(value.cast("bigint").alias(sk), *[c for c in df.columns if c != sk])


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows before each bucket; one row per bucket, so the window is as small as the number of buckets."""
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))


def keys_by_hash(df: DataFrame, key: str, sk: str, start: int = 0, ids: DataFrame | None = None) -> DataFrame:
    """Number the rows in the order of (MD5 of the key, key). The key has to be unique.

    A hash prefix cuts the rows into even buckets that need no sample, so nothing is written in between:
    the counting pass reads the key column only and a recomputed task gives the same keys. ``ids`` is a frame with
    the same keys that is cheaper to scan, for rows that have been through joins. For facts.
    """
    digest = F.md5(F.col(key).cast("string"))
    bucket = F.substring(digest, 1, HASH_DIGITS)
    counted = df if ids is None else ids
    counts = counted.select(bucket.alias("_bucket")).groupBy("_bucket").count()
    # The broadcast below is bounded by the number of buckets.
    offsets = _offsets(counts)
    # Rows are dealt to buckets before they get their digest, so the digest, often wider than all keys of a row, is not moved.
    placed = df.repartition(bucket).withColumns({"_bucket": bucket, "_digest": digest})
    in_bucket = Window.partitionBy("_bucket").orderBy("_digest", key)
    numbered = placed.withColumn("_place", F.row_number().over(in_bucket)).join(F.broadcast(offsets), "_bucket")
    value = F.col("_offset") + F.col("_place") + F.lit(start)
    return numbered.select(value.cast("bigint").alias(sk), *[c for c in df.columns if c != sk])
