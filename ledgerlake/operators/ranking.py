"""Ordered results for reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_measure(df: DataFrame, measure: str, first: Sequence[str] = ()) -> DataFrame:
    """Leading columns ascending, then the measure from high to low."""
    return df.orderBy(
        *[F.col(c).asc_nulls_last() for c in first], F.col(measure).desc_nulls_last()
    )


def top_n(df: DataFrame, n: int, measure: str, ties: Sequence[str]) -> DataFrame:
    """The n rows with the highest measure; ``ties`` fixes which of equal rows are taken.

    Spark keeps n rows per task and merges them, without a full sort.
    """
    return df.orderBy(
        F.col(measure).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]
    ).limit(n)


def top_row(df: DataFrame, measure: str, ties: Sequence[str]) -> DataFrame:
    return top_n(df, 1, measure, ties)


def preview(df: DataFrame, n: int, where: Column | str | None = None) -> DataFrame:
    """Any n rows, for looking at."""
    return (df if where is None else df.where(where)).limit(n)
