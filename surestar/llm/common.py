"""What the corpus operators share: text expressions, tables in the shared folder and connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.session import materialise as store
from surestar.session import shared_folder

__all__ = ["connected_components", "lower_ascii", "lowest_by_hash", "merged_components", "read", "shared_folder", "store", "whole_groups", "word_count"]

#: A word is a run of bytes that are neither a space nor one of the five ASCII control characters for white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lowest_by_hash(df: DataFrame, column: str, most: int) -> DataFrame:
    """At most ``most`` rows: those whose hash of ``column`` is lowest, a sample that does not depend on where rows lie.

    Rows above a bound that leaves about twice as many are dropped first, so what tasks hand on does not grow with their number.
    """
    hashed, n = F.xxhash64(column), df.count()
    if n > 4 * most:
        df = df.where(hashed < F.lit(-(2**63) + 2**64 * 2 * most // n))
    return df.orderBy(hashed, column).limit(most)


def whole_groups(batches: Iterable[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The groups of rows with equal ``column``, one after the other, from batches that are sorted by it."""
    waiting: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        values = pdf[column].to_numpy()
        cuts = [0, *(i for i in (values[1:] != values[:-1]).nonzero()[0] + 1), len(pdf)]
        if waiting and waiting[0][column].iloc[0] != values[0]:
            yield pd.concat(waiting, ignore_index=True)
            waiting = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            waiting.append(pdf.iloc[a:b])
            if b < len(pdf):
                yield pd.concat(waiting, ignore_index=True)
                waiting = []
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of the component of every node that has an edge.

    ``edges`` has two columns of one type, ``u`` and ``v``. Large and small stars alternate until the edges are stars
    around the smallest nodes, which an aggregate at the beginning of each round tells, so edges that are stars cost that one. A round is
    three more aggregates and two joins, and what is gathered per node is one minimum or two counts, so a node with a third of all edges is one row of an
    aggregate and a splittable join key. The result is ``node``, ``root`` and leaves out the roots themselves. Loops are ignored; null ends
    are not allowed; no edges give no rows.
    """

    def linked(e: DataFrame) -> DataFrame:
        """Pairs with the larger node first."""
        return e.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    current = store(linked(edges))
    while not current.isEmpty():
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        counts = F.count_if(F.col("v") < F.col("u")).alias("below"), F.count_if(F.col("v") > F.col("u")).alias("above")
        if not both.groupBy("u").agg(*counts).agg(F.count_if(F.expr("below > 1 OR (below = 1 AND above > 0)"))).first()[0]:
            break
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        # An edge gives one row, in which the larger node is first, so what repeats may stay until the round ends.
        large = store(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = store(linked(small.union(least.select("u", F.col("m").alias("v")))))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def merged_components(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """What ``connected_components`` gives once ``edges`` between roots, or nodes without an edge so far, are added to those that gave ``roots``."""
    over = connected_components(edges)
    tops = over.select(F.col("node").alias("root"), F.col("root").alias("__top"))
    return roots.join(tops, "root", "left").select("node", F.coalesce("__top", "root").alias("root")).union(over)
