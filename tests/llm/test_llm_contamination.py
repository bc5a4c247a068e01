import random
import re
from collections import Counter

import pytest
from llm_cases import SCHEMA, frame, messy, sentence

from lakemill.llm import contamination

ITEMS = "item_id bigint, text string, phrase string, term string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(item)
    out = Counter()
    for i, text, *_ in rows:
        own, hit, named = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(own) - n + 1):
                if (found := windows.get(tuple(own[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    named |= found
        out[i, len(own), len(hit), tuple(sorted(n for n in named if n is not None))] += 1
    return out


def found(spark, rows, items, df=None):
    items = spark.createDataFrame([(*i, "clash", "clash") for i in items], ITEMS)
    df = frame(spark, rows) if df is None else df
    rows = contamination.find_contamination(df, items).select("id", "n_words", "n_hit", "items").collect()
    return Counter((r.id, r.n_words, r.n_hit, tuple(sorted(r["items"]))) for r in rows)


def case(seed):
    rng = random.Random(seed)
    vocabulary = rng.choice([3, 40, 400])
    items = [(i, sentence(rng, rng.choice([1, 4, 9, 10, 11, 30]), vocabulary)) for i in range(8)]
    items += [(20, items[2][1]), (21, None), (22, "..."), (None, items[4][1]), (23, items[5][1].upper().replace(" ", "-"))]
    rows = []
    for i in range(40):
        parts = [sentence(rng, rng.randrange(0, 40), vocabulary)]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1] or ""
            w = w.split()
            a = rng.randrange(len(w) + 1)
            parts += [" ".join(w[a : a + rng.randrange(1, 31)]), sentence(rng, rng.randrange(5), vocabulary)]
        rows.append((i, ", ".join(parts), "en", "s"))
    return rows + messy(), items


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    rows, items = case(seed)
    assert found(spark, rows, items) == brute(rows, items)


def test_no_documents_or_no_items(spark):
    rows, items = case(1)
    assert found(spark, rows, []) == brute(rows, [])
    assert found(spark, [], items, spark.createDataFrame([], SCHEMA)) == Counter()


def test_clean_documents_stay_with_all_columns(spark):
    rows, items = case(2)
    df = frame(spark, rows)
    kept = contamination.decontaminate(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == df.columns
    expected = Counter()
    for (i, n, hit, _), times in brute(rows, items).items():
        expected[i] += times * (hit == 0)
    assert Counter(r.doc_id for r in kept.collect()) == +expected


def test_vocabulary_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr("lakemill.llm.common.BROADCAST_BYTES", -1)
    rows, items = case(0)
    assert found(spark, rows, items) == brute(rows, items)


def test_proximity_admits_words_in_between(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = item.replace("delta", "delta extra")
    rows = [(1, f"x y {item} z", "en", "s"), (2, f"x {near} z", "en", "s"), (3, "alpha x " * 9 + "kappa", "en", "s")]
    rows += [(4, " ".join(reversed(item.split())), "en", "s")]
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    exact = contamination.proximity_matches(frame(spark, rows), items, slop=0, lists=10).collect()
    assert {(r.doc_id, r.item_id) for r in exact} == {(1, 7)}
    close = contamination.proximity_matches(frame(spark, rows), items, slop=1, lists=10).collect()
    assert {(r.doc_id, r.item_id) for r in close} == {(1, 7), (2, 7)}


def test_no_python_runs(spark):
    rows, items = case(0)
    items = spark.createDataFrame(items, "item_id bigint, text string")
    plan = contamination.find_contamination(frame(spark, rows), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_words_are_cut_as_by_the_expression(spark):
    texts = ["".join(map(chr, range(300))), "A\0b \x7fÜx\U0001f600y,C9_d`e{f", "", None, " \t", "é", "\x85\xa0a b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.w for r in df.select(contamination.terms_of("text").alias("w")).collect()] == [words(t) for t in texts]


def test_index_cuts_each_text_once(spark, monkeypatch):
    plans = []

    def kept(df, purpose):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(contamination, "keep", kept)
    rows = [(1, "a b", "en", "s"), (2, None, "en", "s"), (3, ".", "en", "s")]
    index = contamination.build_index(frame(spark, rows))
    assert sorted((r.term, r.pos) for r in index.collect()) == [("a", 0), ("b", 1)]
    assert "regexp_extract_all(" not in plans[0] and plans[0].count("translate(") == 1
