from pathlib import Path

import duckdb
import pytest
from llm_cases import frame, messy
from test_llm_contamination import brute as contaminated
from test_llm_order_minhash import distance, words_of

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"


def plain(rows, items):
    """The first four stages in plain Python; every text here is in a learned language."""
    rows = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    best = {}
    for r in rows:
        key = "".join((r[1]).split())
        if key not in best or (-len(r[1]), r[0]) < (-len(best[key][1]), best[key][0]):
            best[key] = r
    rows = sorted(best.values())
    words, root = [words_of(t) for _, t, *_ in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = words[i], words[j]
            longer = max(len(a), len(b))
            # words in common bound the edits from below
            if longer and longer - len(set(a) & set(b)) - (longer - len(set(a))) <= 0.2 * longer and find(i) != find(j):
                if abs(len(a) - len(b)) <= 0.2 * longer and distance(a, b) <= 0.2 * longer + 1e-9:
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    rows = [r for i, r in enumerate(rows) if find(i) == i]
    hit = {i for (i, _, n, _), _ in contaminated(rows, items).items() if n}
    return {r[0] for r in rows if r[0] not in hit}


@pytest.mark.skipif(not Path(SMALL).is_dir(), reason="needs the driver tables")
def test_stages_against_plain_python(spark):
    db = duckdb.connect()
    rows = db.sql(f"SELECT doc_id, text, lang, source FROM '{SMALL}/documents.parquet' WHERE length(text) < 2500").fetchall()
    items = db.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    assert {r.doc_id for r in docs.collect()} == plain(rows, items)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in docs.collect()}
    assert all(0 < r.mix.taken <= 3 * r.mix["size"] for r in mixed)


@pytest.mark.skipif(not Path(SMALL).is_dir(), reason="needs the driver tables")
def test_stages_stand_messy_and_no_rows(spark):
    for rows in (messy(), messy()[:1]):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs if rows else docs.limit(0), SMALL)
            assert out.columns[: len(docs.columns)] == docs.columns
            out.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, messy()).where("false"), SMALL).count() == 0


def test_registered():
    names = set(queries())
    numbers = {int(n[2:].split("_")[0]) for n in names if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in names
    assert set(oracle_sql()) <= names
