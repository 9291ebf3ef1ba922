"""Counts, latest rows and top rows over control tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column).count()
        .orderBy(F.desc("count"), column)
    )


def status_totals(df: DataFrame, status: str = "upload_status") -> DataFrame:
    """Total, successful and failed rows in one pass."""
    return df.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col(status) == "SUCCESS").alias("success"),
        F.count_if(F.col(status) == "FAILED").alias("failed"),
    )


def shape(df: DataFrame) -> tuple[int, int]:
    """Rows and columns."""
    return df.count(), len(df.columns)


def latest(df: DataFrame, order: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """The last row by ``order``, for the whole frame or for each group.

    Every task sorts and reduces its rows before the shuffle, so a hot group is no
    bottleneck.
    """
    last = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    grouped = df.groupBy(*per) if per else df.groupBy()
    return grouped.agg(last).where(F.col("_row").isNotNull()).select("_row.*")


def latest_file(landing: DataFrame, condition: Column) -> DataFrame:
    """The newest snapshot's file among those that meet a condition."""
    found = latest(landing.where(condition), ["snapshot_date", "source_path"]).first()
    if found is None:
        raise ValueError("No file meets the condition")
    return landing.sparkSession.createDataFrame([found], landing.schema)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows by ``order``."""
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` rows by ``order``, in that order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)
