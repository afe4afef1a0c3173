"""Audit rows: one per step, with real row counts."""

from __future__ import annotations

import datetime as dt
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surestar.operators.rules import KEPT
from surestar.schemas import AUDIT

OK, ERROR, SKIPPED = "OK", "ERROR", "SKIPPED"


@dataclass
class AuditRow:
    started: dt.datetime
    ended: dt.datetime
    step: str
    rows_in: int | None
    rows_out: int | None
    rows_rejected: int | None
    status: str
    message: str | None = None


def audit_frame(spark: SparkSession, rows: list[AuditRow]) -> DataFrame:
    """Audit rows of one run (a few dozen) as a frame."""
    return spark.createDataFrame([astuple(row) for row in rows], AUDIT)


def observe_marked(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows in, kept and rejected while the frame is written; no extra pass."""
    seen = Observation()
    good = F.col(KEPT)
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(good).alias("rows_out"),
        F.count_if(~good).alias("rows_rejected"),
    ), seen


def observe_rows(df: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    """Count the rows of a frame, and whatever else is asked for, while it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows_out"), *more), seen


def step_counts(step: str, marked: DataFrame) -> DataFrame:
    """Rows in, kept and rejected of one curation step as a one-row frame."""
    good = F.col(KEPT)
    return marked.agg(
        F.lit(step).alias("step"),
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(good).alias("rows_out"),
        F.count_if(~good).alias("rows_rejected"),
    )
