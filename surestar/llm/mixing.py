"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the rows stand in the order of their keys, which is a range sort whose bounds are
known beforehand: the first bits of a key number its range. Word counts are summed per source and range, prefix sums over the
ranges find the range in which the budget of the source ends, and prefix sums inside this one range find the row. Whole epochs come
first: a source with a target of 1.4 times its size is taken once in full and 0.4 times in the order of the keys. A budget
ends exactly; the row in which it ends is taken in part.

No source meets in one task: the sums per range are combined before the shuffle, and only the range of the cut is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surestar.llm.common import WORD

#: Keys have 60 bits, the first 12 of them number the range.
KEY_BITS, RANGE_SHIFT = 60, 48


def random_key(doc_id: Column, seed: str = "mix") -> Column:
    """``KEY_BITS`` random bits from the id as text; null counts as the empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with the weights dealt in turn by code point of the source, null last.

    One row per source: the list a user would otherwise write down by hand, so one window may order it.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return sizes.withColumn("weight", F.get(listed, place % len(weights)))


def shared_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Split ``share`` times all words by weight; a target stops at ``most`` times its source, the others share the rest.

    Repeating that until no target is too high ends where all sources below their stop have the same ratio of target to
    weight, so the sources are put in the order in which they would stop and the ratio follows from two running sums.
    """
    order = Window.orderBy(F.col("__stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(share)
    stops = sources.withColumn("__stop", F.col("source_size") * F.lit(most))
    ratio = (budget - F.coalesce(F.sum("__stop").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    stops = stops.withColumn("__ratio", ratio)
    free = F.max(F.when(F.col("__stop") > F.col("__ratio") * F.col("weight"), F.col("__ratio"))).over(Window.partitionBy())
    first = F.max(F.when(F.col("__stop") > F.col("__ratio") * F.col("weight"), 1)).over(Window.partitionBy())
    target = F.when(first.isNull(), F.col("__stop")).otherwise(F.least("__stop", free * F.col("weight")))
    return stops.withColumn("target", target).drop("__stop", "__ratio")


def cuts(rows: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, ``epochs``, ``cut_key``, ``left``.

    ``rows`` has ``source``, ``key`` (60 bits) and ``size``. Rows with a smaller key than ``cut_key`` are taken ``epochs``
    times and once more, the others ``epochs`` times; ``left`` words remain for the rows that have that very key.
    """
    ranges = rows.groupBy("source", F.shiftright("key", RANGE_SHIFT).alias("range")).agg(F.sum("size").alias("words"))
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = shared_targets(weighted_sources(sizes, weights), share, most)
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("more", words - epochs * F.col("source_size"))
    running = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("upto", F.sum("words").over(running)).withColumnRenamed("source", "s")
    at = ranges.join(targets, F.col("s").eqNullSafe(F.col("source")))
    at = at.where("upto > more AND upto - words <= more").select(
        *targets.columns, "range", (F.col("more") - F.col("upto") + F.col("words")).alias("within")
    )
    inside = rows.select(F.col("source").alias("s"), "key", "size")
    same = F.col("s").eqNullSafe(F.col("source")) & (F.shiftright("key", RANGE_SHIFT) == F.col("range"))
    inside = inside.join(at.select("source", "range", "within"), same).groupBy("source", "key", "within").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("key"))
    inside = inside.withColumn("upto", upto).where("upto > within AND upto - n <= within")
    inside = inside.select(F.col("source").alias("s"), F.col("key").alias("cut_key"), (F.col("within") - F.col("upto") + F.col("n")).alias("left"))
    return targets.join(inside, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "epochs",
        F.coalesce("cut_key", F.lit(1 << KEY_BITS)).alias("cut_key"), F.coalesce("left", F.lit(0)).cast("long").alias("left"),
    )


def take(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (with ``source``, ``key``, ``size`` and any others) with ``source_size``, ``target`` and ``taken``.

    Rows that share the cut key of their source get what is left one after the other, in the order of their sizes.
    """
    found = found.withColumnRenamed("source", "__source")
    rows = rows.join(found, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    whole = rows.where("key != cut_key")
    more = F.when(F.col("key") < F.col("cut_key"), F.col("size")).otherwise(0)
    whole = whole.withColumn("taken", F.col("epochs") * F.col("size") + more)
    tied = rows.where("key = cut_key")
    before = F.sum("size").over(Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.coalesce(before, F.lit(0))))
    tied = tied.withColumn("taken", F.col("epochs") * F.col("size") + more)
    return whole.unionByName(tied).drop("epochs", "cut_key", "left")


def copies(taken: DataFrame) -> DataFrame:
    """Rows of a mix written out: a text for each time it is taken, and the first words of one that is taken in part.

    ``taken`` is a result of ``take`` with ``text`` and ``n_chars``; the text of a cut row is its words joined by spaces.
    """
    times = F.floor(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    part = (F.col("taken") - times * F.col("size")).cast("int")
    pieces = F.concat(
        F.array_repeat(F.struct(F.lit(True).alias("whole"), F.lit(0).alias("words")), times),
        F.when(part > 0, F.array(F.struct(F.lit(False).alias("whole"), part.alias("words")))).otherwise(F.array().cast("array<struct<whole:boolean,words:int>>")),
    )
    rows = taken.withColumn("__piece", F.explode(pieces))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("__piece.words")), " ")
    rows = rows.withColumn("text", F.when(F.col("__piece.whole"), F.col("text")).otherwise(cut))
    return rows.withColumn("n_chars", F.when(F.col("__piece.whole"), F.col("n_chars")).otherwise(F.length("text")))
