"""Anti joins, reconciliation joins and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key never has one.

    NULL keys are split off before the join: they would all hash to one task.
    """
    keyed = child.where(F.col(key).isNotNull())
    unmatched = keyed.join(parent.select(key), key, "left_anti").select(*child.columns)
    return child.where(F.col(key).isNull()).unionByName(unmatched)


def orphan_count(
    child: DataFrame, parent: DataFrame, key: str, name: str, parent_is_unique: bool = False
) -> DataFrame:
    """Number of child rows without a parent, as one row.

    Children are counted per key before the join, so a frequent key or NULL joins as
    one row; the join then reuses the partitioning of that count.  Parents are reduced
    to distinct keys unless they are known to be unique.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("n"))
    parents = parent.select(key).where(F.col(key).isNotNull())
    if not parent_is_unique:
        parents = parents.distinct()
    orphans = per_key.join(parents, key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def differing_groups(
    left: DataFrame, right: DataFrame, key: str, differs: Column
) -> DataFrame:
    """Full outer join of two results keyed alike, keeping the groups that differ.

    A NULL key matches nothing, so such a group shows up once from each side.
    """
    return left.join(right, key, "full_outer").where(differs)


def union_labelled(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION: rows equal in all columns appear once, whichever input they come from."""
    return reduce(DataFrame.union, parts).distinct()


def row_counts(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One row per table: ``entity`` and its row count."""
    return union_labelled([
        df.agg(F.count("*").alias(name)).select(F.lit(entity).alias("entity"), name)
        for entity, df in tables.items()
    ])
