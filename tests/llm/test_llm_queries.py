"""The queries against their SQL oracles, and what the others promise, on the smallest driver tables."""

from pathlib import Path
from zlib import crc32

import pytest
from oracle_check import compare, oracle

from lakemill.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="needs the driver tables")


@pytest.fixture(scope="module")
def db():
    return oracle(SMALL)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_oracle(spark, db, name):
    assert compare(spark, db, name, SMALL) == ""


def test_every_document_has_one_row(spark, db):
    ids = sorted(r[0] for r in db.sql("SELECT doc_id FROM documents").fetchall())
    others = {"op4_chat_prefix_targets", "op5_warc_round_trip", "op11_conversation_trie", "op13_source_divergence"}
    for name in set(QUERIES) - others:
        assert sorted(r.doc_id for r in QUERIES[name](spark, SMALL).select("doc_id").collect()) == ids, name


def test_held_out_languages(spark, db):
    lang = dict(db.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op2_language_id"](spark, SMALL).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    away = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in away) >= 0.95 * len(away)


def test_toxicity_scores(spark, db):
    rows = QUERIES["op1_toxicity"](spark, SMALL).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
