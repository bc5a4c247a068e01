"""Sorted and limited reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, by: str, name: str = "count") -> DataFrame:
    """Rows per value of one column."""
    return df.groupBy(by).agg(F.count("*").alias(name))


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows in the given order; each task keeps only its own ``k``.

    Give an order without ties, or the rows at the edge are arbitrary.
    """
    return df.orderBy(*order).limit(k)


def largest(df: DataFrame, measure: str, ties: Sequence[str], k: int | None = None) -> DataFrame:
    """Rows by descending measure, ties by ascending key, optionally only the first ``k``."""
    order = [F.col(measure).desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in ties)]
    return df.orderBy(*order) if k is None else top(df, k, *order)
