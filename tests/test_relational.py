"""Dedup, anti join, reconciliation, set and top-k building blocks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from lakemill.operators.dedup import any_per_key, distinct_rows, latest_per_key
from lakemill.operators.relate import (
    differing_groups,
    orphan_count,
    orphan_rows,
    row_counts,
    union_distinct,
    union_labelled,
)
from lakemill.operators.topk import counted, largest, top


@pytest.fixture(scope="module")
def loads(spark):
    data = [
        (1, "a", 1), (1, "b", 2), (1, "c", 2), (2, None, 1), (2, "x", 1), (None, "n", 1), (None, "m", 3), (3, "z", None),
    ]
    return spark.createDataFrame(data, "k int, v string, ts int")


def test_latest_per_key_breaks_ties_and_keeps_a_null_key(loads):
    assert rows(latest_per_key(loads, ["k"], "ts")) == [(None, "m", 3), (1, "c", 2), (2, "x", 1), (3, "z", None)]


def test_any_per_key_is_the_same_row_however_the_input_is_partitioned(loads):
    expected = [(None, "m", 3), (1, "a", 1), (2, "x", 1), (3, "z", None)]
    for n in (1, 3, 8):
        assert rows(any_per_key(loads.repartition(n), ["k"])) == expected


def test_dedup_limits_each_key_before_the_shuffle(loads):
    plan = plan_of(latest_per_key(loads, ["k"], "ts"))
    assert plan.index("Partial") > plan.index("Exchange")  # children print below their parents


def test_distinct_rows(loads):
    assert rows(distinct_rows(loads, "k")) == [(None,), (1,), (2,), (3,)]


def test_orphans_match_the_left_join_form(spark):
    rng = random.Random(7)
    keys = [None, *range(30)]
    child_rows = [(i, rng.choice(keys)) for i in range(500)] + [(1000 + i, 29) for i in range(300)]
    child = spark.createDataFrame(child_rows, "id int, k int")
    parent = spark.createDataFrame([(k,) for k in [None, *range(0, 30, 2)] for _ in range(3)], "k int")
    present = set(range(0, 30, 2))
    expected = sorted(r for r in child_rows if r[1] not in present)
    assert sorted((r.id, r.k) for r in orphan_rows(child, parent, "k").collect()) == expected
    assert orphan_rows(child, parent, "k").columns == child.columns
    assert orphan_count(child, parent, "k", "bad").first().bad == len(expected)
    unique = parent.distinct()
    assert orphan_count(child, unique, "k", "bad", parent_is_unique=True).first().bad == len(expected)
    assert orphan_count(child, child, "k", "bad").first().bad == sum(k is None for _, k in child_rows)


def test_differing_groups_reports_a_null_key_from_both_sides(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("a", 1), ("c", 2), (None, 3)], "k string, r int")
    differs = F.coalesce("l", F.lit(0)) != F.coalesce("r", F.lit(0))
    assert rows(differing_groups(left, right, "k", differs)) == [
        (None, None, 3), (None, 3, None), ("b", 2, None), ("c", None, 2),
    ]


def test_unions(spark):
    a, b = spark.range(3), spark.range(3)
    assert union_labelled([a, b]).count() == 6
    assert union_distinct([a.agg(F.count("*")), b.agg(F.count("*"))]).count() == 1
    assert rows(row_counts({"a": a, "b": spark.range(0)}, "n")) == [("a", 3), ("b", 0)]


def test_top_and_largest(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), (None, 2), ("c", 5), ("d", None)], "k string, n int")
    assert [r.k for r in largest(df, "n", ["k"]).collect()] == ["c", None, "a", "b", "d"]
    assert [r.k for r in largest(df, "n", ["k"], 2).collect()] == ["c", None]
    assert "TakeOrderedAndProject" in plan_of(top(df, 2, "k"))
    assert rows(counted(df, "n")) == [(None, 1), (2, 3), (5, 1)]
