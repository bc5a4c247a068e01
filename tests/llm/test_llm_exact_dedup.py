import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest
from llm_cases import SCHEMA, frame, messy
from pyspark.sql import functions as F

from lakemill.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((doc_id, len(text or "")))
    out = Counter()
    for body, members in groups.items():
        order = lambda m: (-m[1], m[0] is None, m[0] or 0)
        keep = min(members, key=order)
        for m in members:
            out[m[0], keep[0], len(members), m == keep, sha256(body.encode()).hexdigest()] += 1
    return out


def marked(df, **options):
    found = exact_dedup.mark_duplicates(df, **options)
    return Counter(tuple(r) for r in found.select("id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_brute_force(spark):
    assert marked(frame(spark, messy())) == brute(messy())


def test_colliding_hashes_are_told_apart_by_bytes(spark):
    assert marked(frame(spark, messy()), digest=lambda body: F.lit("x")) == brute(messy())


def test_the_smallest_and_largest_ids(spark):
    rows = [(i, text, "en", "s") for text in ("same", "other") for i in (-(1 << 63), (1 << 63) - 1, None, 0)]
    assert marked(frame(spark, rows)) == brute(rows)
    assert {r.doc_id for r in exact_dedup.deduplicate(frame(spark, rows)).collect()} == {-(1 << 63)}


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert marked(df) == Counter() and exact_dedup.deduplicate(df).count() == 0


def test_one_document_of_each_text_stays_with_all_columns(spark):
    df = frame(spark, messy())
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    texts = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t, *_ in messy()})
    assert {r.kept for r in kept.collect()} == {"clash"}


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_hot_group(spark, partitions):
    rows = [(i, "same text" if i % 3 else f"text {i}", "en", "s") for i in range(600)]
    assert marked(frame(spark, rows, partitions)) == brute(rows)


def test_no_python_runs(spark):
    plan = exact_dedup.mark_duplicates(frame(spark, messy()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
