"""Order along a space-filling curve, so that files have narrow ranges of several columns at once.

Each column's value becomes its rank among sampled quantiles, a number of ``RANK_BITS`` bits; the bits of all
ranks are interleaved, the first column's first (Z-order).  Rows near each other on the curve are near in every column.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

RANK_BITS = 10
#: Rows that quantiles are taken from; this many values of a column meet in one task.
SAMPLED_ROWS = 50_000
#: Characters of a text that its rank depends on.
RANKED_CHARS = 64


def _ranked(df: DataFrame, column: str) -> Column:
    text = isinstance(df.schema[column].dataType, StringType)
    return F.substring(F.col(column), 1, RANKED_CHARS) if text else F.col(column)


def quantiles(df: DataFrame, columns: Sequence[str], bits: int = RANK_BITS) -> dict[str, list[str]]:
    """At most 2^bits - 1 distinct values, as text, that cut each column into parts of about equal size, from a sample.

    The sample has about ``SAMPLED_ROWS`` rows, and only the cuts come to the driver.
    """
    rows = df.count()
    picked = df.select(*(_ranked(df, c).alias(c) for c in columns))
    if rows > SAMPLED_ROWS:
        picked = picked.sample(SAMPLED_ROWS / rows, seed=1)
    parts = 1 << bits

    # sorted once, below the lambda that looks into it
    ordered = picked.agg(*(F.collect_list(c).alias(c) for c in columns)).select(*(F.sort_array(c).alias(c) for c in columns))

    def cuts(column: str) -> Column:
        at = F.transform(
            F.sequence(F.lit(1), F.lit(parts - 1)),
            lambda i: F.get(column, F.floor(i * F.size(column) / F.lit(parts)).cast("int")),
        )
        return F.array_distinct(F.filter(at, lambda v: v.isNotNull())).cast("array<string>").alias(column)

    return ordered.select(*(cuts(c) for c in columns)).first().asDict()


def _with_ranks(
    df: DataFrame, columns: Sequence[str], cuts: dict[str, list[str]], names: Sequence[str], bits: int
) -> DataFrame:
    """Rows with how many cuts of each column are not above its value, spread over all of the bits; NULL ranks lowest.

    A binary search of one column a step, which stays inside generated code, unlike a lambda over the steps.
    """
    values = {name: f"{name}_value" for name in names}
    found = df.withColumns({values[name]: _ranked(df, c) for name, c in zip(names, columns)}).withColumns(
        {name: F.lit(0) for name in names}
    )
    sorted_cuts = {}
    for name, c in zip(names, columns):
        # one literal, which the optimizer turns into an array once
        as_text = F.from_json(F.lit(json.dumps(list(cuts[c]))), "array<string>")
        sorted_cuts[name] = as_text.cast(f"array<{df.schema[c].dataType.simpleString()}>")
    for i in reversed(range(max(len(cuts[c]) for c in columns).bit_length())):
        step = 1 << i
        found = found.withColumns({
            name: F.when(
                F.get(sorted_cuts[name], F.col(name) + (step - 1)) <= F.col(values[name]), F.col(name) + step
            ).otherwise(F.col(name))
            for name, c in zip(names, columns) if step <= len(cuts[c])
        })
    # few distinct values would only reach the lowest bits, which count for nothing beside another column's
    spread = {
        name: F.floor(F.col(name).cast("bigint") * (1 << bits) / (len(cuts[c]) + 1)).cast("bigint")
        for name, c in zip(names, columns)
    }
    return found.withColumns({
        name: F.when(F.col(values[name]).isNull(), F.lit(0).cast("bigint")).otherwise(spread[name]) for name in names
    }).drop(*values.values())


def with_position(df: DataFrame, columns: Sequence[str], name: str, bits: int = RANK_BITS) -> DataFrame:
    """Rows with their position on the curve through some columns."""
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into a position of 62")
    ranks = [f"{name}_rank{i}" for i in range(len(columns))]
    ranked = _with_ranks(df, columns, quantiles(df, columns, bits), ranks, bits)
    position = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            position = position.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - i))
    return ranked.withColumn(name, position).drop(*ranks)


def along_curve(df: DataFrame, columns: Sequence[str], partitions: int, bits: int = RANK_BITS) -> DataFrame:
    """Rows in partitions that are pieces of the curve, in its order.

    The row number of the scan is the last range key, as values that fill a third of the table share a position.
    """
    placed = with_position(df, columns, "_curve", bits).withColumn("_scan_row", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(partitions, "_curve", "_scan_row").sortWithinPartitions("_curve", *columns)
    return ranged.drop("_curve", "_scan_row")
