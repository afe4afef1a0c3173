"""Corpus pipeline: quality classifier, SimHash near-dedup, mixing to target weights, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.llm import mixing, packing, quality, simhash_dedup
from surestar.llm.common import read, store
from surestar.llm.queries import ACCEPTED, quality_model, sized_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_model(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= ACCEPTED).select(COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash_dedup.keep_first(docs.select(COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix written out: a row for each time a document is taken; a document without words adds nothing to it."""
    sized = sized_documents(docs.select(COLUMNS))
    found = store(mixing.cuts(store(sized.select("doc_id", "source", "key", "size"))))
    return mixing.copies(mixing.take(sized, found)).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence and the place in it that each one gets."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier and the fingerprints can't be written in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
