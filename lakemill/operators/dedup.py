"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    The ``= 1`` filter makes Spark keep one row per key in every map task before the
    shuffle (``WindowGroupLimit``), so a key with most of the rows sends one row per
    task and no reducer sees it whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _sortable(df: DataFrame, without: Sequence[str]) -> list[str]:
    return [
        field.name
        for field in df.schema
        if field.name not in without and not isinstance(field.dataType, (MapType, VariantType))
    ]


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, always the same one: the smallest by the remaining columns, NULLs last.

    So a row whose fields could be read goes before one with a field that could not.  ``dropDuplicates`` may pick another row when a lost task runs again.
    """
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in _sortable(df, keys)])


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: str) -> DataFrame:
    """Row with the greatest ``latest_by`` per key; the other columns break ties.

    The load time is one value per load, so copies within a load always tie.
    """
    ties = _sortable(df, [*keys, latest_by])
    order = [F.col(latest_by).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in ties)]
    return first_per_key(df, keys, order)


def distinct_rows(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(*columns).distinct()
