import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from llm_cases import SCHEMA, frame, messy
from pyspark.sql import functions as F

from lakemill.llm import toxicity

CLEAN = "the river runs past an old stone mill and green hills where sheep graze near tall trees in summer rain pass grass".split()
INSULTS = ["idiot", "moron", "loser", "pathetic", "scum", "ass"]
RUSSIAN = "река течёт мимо старой мельницы и зелёных холмов где пасутся овцы летом идёт дождь отец".split()


def corpus(n=900, seed=3, clean=CLEAN, insults=INSULTS):
    rng = random.Random(seed)
    rows, labels = [], {}
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 40))]
        labels[i] = int(i % 4 == 0)
        if labels[i]:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), "en", "s"))
    return rows, labels


def restored(docs, model):
    return docs.select("doc_id", toxicity.restored_words(docs, model, F.col("text")).alias("words"))


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    model = toxicity.char_model(toxicity.learn_characters(docs))
    table = spark.createDataFrame([(i, x) for i, x in labels.items()] + [(1, None)], "doc_id bigint, toxic int")
    return model, *toxicity.learn_words(restored(docs, model).join(table, "doc_id"))


@pytest.mark.parametrize(
    ("written", "word"),
    [
        ("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"), ("l-o-s-e-r", "loser"),
        ("morooon", "moron"), ("p@thet1c", "pathetic"), ("$cum", "scum"), ("M 0 R 0 N", "moron"), ("iiidiooot", "idiot"),
        ("a$$", "ass"), ("4$$", "ass"), ("@$$", "ass"), ("m  o  r  o  n", "moron"), ("moron$$$", "moron"),
        ("**moron**", "moron"), ("(moron", "moron"), ("идиот", "идиот"), ("第3章", "第3章"),
        ("ïdíöt", "idiot"), ("id​iot", "idiot"), ("idiоt", "idiot"), ("moron!!!", "moron"), ("loser", "loser"),
    ],
)
def test_restored(learned, written, word):
    assert word in toxicity.Restorer(learned[0]).words(f"the {written} near trees")


def best_path(model, token, spaced):
    """All paths of the lattice."""
    paths = [(0.0, "")]
    for letters, price in toxicity._lattice(token, spaced):
        paths = [(c + p, t + x) for c, t in paths for x, p in zip(letters, price, strict=True)]

    def total(path):
        text = f"  {path[1]} "
        code = [toxicity._letter(c) for c in text]
        return path[0] + sum(model.cost[code[i]][code[i + 1]][code[i + 2]] for i in range(len(code) - 2))

    return min(map(total, paths)), {p[1]: total(p) for p in paths}


def test_viterbi_finds_the_cheapest_path(learned):
    for token, spaced in [("1d10t", False), ("m00r0nn", False), ("p4th3t1c", False), ("anidiot", True), ("55", False), ("$$moron!!", False), ("4$$", False)]:
        cheapest, totals = best_path(learned[0], token, spaced)
        assert totals[learned[0].restore(token, spaced)] == pytest.approx(cheapest)


def test_character_counts_cover_all_texts(spark):
    rows = messy()
    counts = {r.code: r.n for r in toxicity.learn_characters(frame(spark, rows)).collect()}
    expected = Counter()
    for _, text, *_ in rows:
        for token in filter(str.isalpha, toxicity.written_tokens(text or "")[0]):
            padded = f"  {toxicity._folded(token)} "
            expected.update(toxicity.CharModel.code(*padded[i : i + 3]) for i in range(len(padded) - 2))
    assert counts == expected


def scores(spark, rows, learned):
    found = toxicity.score(restored(frame(spark, rows), learned[0]), *learned[1:]).collect()
    return {r.doc_id: r.score for r in found}


def test_held_out_rows_plain_and_disguised(spark, learned):
    rows, labels = corpus(300, seed=9)
    disguise = {"idiot": "1d10t", "moron": "m o r o n", "loser": "looooser", "pathetic": "p@thetic", "scum": "s.c.u.m"}
    hidden = [(i, " ".join(disguise.get(w, w) for w in t.split()), lang, s) for i, t, lang, s in rows]
    for case in (rows, hidden):
        found = scores(spark, case, learned)
        assert all(0 <= x <= 1 for x in found.values())
        right = sum((found[i] >= 0.5) == bool(labels[i]) for i in labels)
        assert right >= 0.99 * len(labels)


def test_cyrillic_words_are_learnt_and_restored(spark):
    rows, labels = corpus(300, clean=RUSSIAN, insults=["идиот", "дурак"])
    docs = frame(spark, rows)
    model = toxicity.char_model(toxicity.learn_characters(docs))
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    learned = model, *toxicity.learn_words(restored(docs, model).join(table, "doc_id"))
    texts = ["река течёт", "река идиот", "река ид1от", "и д и о т летом", "дурaк", "дурааак!!!", "отец и дождь"]
    found = scores(spark, [(i, t, "ru", "s") for i, t in enumerate(texts)], learned)
    assert [found[i] >= 0.5 for i in range(len(texts))] == [False, True, True, True, True, True, False]


def brute_force(rows, labels, words_of):
    """Scores of the rows, learnt from the labelled ones."""
    found = {i: words_of(text) for i, text, *_ in rows}
    sides = [[found[i] for i, x in labels.items() if x == side] for side in (0, 1)]
    clean, toxic = map(len, sides)
    weights, none = {}, math.log(toxic / clean)
    for word in set().union(*sides[0], *sides[1]):
        c, t = (sum(word in words for words in side) for side in sides)
        p, q, rate = (t + 0.5) / (toxic + 1), (c + 0.5) / (clean + 1), (t + c) / (toxic + clean)
        cells = [(t, toxic * rate), (c, clean * rate), (toxic - t, toxic * (1 - rate)), (clean - c, clean * (1 - rate))]
        deviance = 2 * sum(seen * math.log(seen / expected) for seen, expected in cells if seen)
        drawn = math.log(p / q) * max(0.0, 1 - toxicity.DOUBT**2 / max(deviance, 1e-9))
        if drawn < 0:
            q = p * math.exp(-drawn)
        else:
            p = q * math.exp(drawn)
        absent = math.log((1 - p) / (1 - q))
        weights[word] = drawn - absent
        none += absent
    return {i: 1 / (1 + math.exp(-none - sum(weights.get(w, 0) for w in words))) for i, words in found.items()}


@pytest.mark.parametrize("frequent", [100_000, 7])
def test_scores_as_brute_force_however_many_words_are_broadcast(spark, learned, monkeypatch, frequent):
    monkeypatch.setattr(toxicity, "FREQUENT_WORDS", frequent)
    rows, labels = corpus()
    rows += [(900 + i, text, "en", "s") for i, text in enumerate(["", None, "... 42 $", "an unknown word"])]
    labels |= {900: 0, 901: 0, 902: 0}
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    taught = learned[0], *toxicity.learn_words(restored(frame(spark, rows), learned[0]).join(table, "doc_id"))
    expected = brute_force(rows, labels, toxicity.Restorer(learned[0]).words)
    found = scores(spark, rows, taught)
    assert found == pytest.approx(expected, abs=1e-6)
    assert sum((found[i] >= 0.5) == bool(x) for i, x in labels.items()) >= 0.99 * len(rows)


def test_a_few_rows_teach_a_word(spark, learned):
    rows, labels = corpus(40, insults=["moron"])
    labels = {i: int("moron" in text) for i, text, *_ in rows}
    table = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    few = learned[0], *toxicity.learn_words(restored(frame(spark, rows), learned[0]).join(table, "doc_id"))
    assert {i: int(s >= 0.5) for i, s in scores(spark, rows, few).items()} == labels


def test_messy_rows_and_empty_texts(spark, learned):
    found = scores(spark, messy(), learned)
    assert found[300] == found[301] == found[302] and 0 <= found[300] < 0.5
    nothing = learned[0], learned[1].limit(0), -math.inf
    assert scores(spark, [(1, "the river", "en", "s")], nothing) == {1: pytest.approx(0, abs=1e-9)}


def test_no_rows_or_one_label(spark, learned):
    empty = spark.createDataFrame([], SCHEMA)
    model = toxicity.char_model(toxicity.learn_characters(empty))
    for docs in (empty, frame(spark, messy())):
        one_label = restored(docs, model).withColumn("toxic", F.lit(1))
        words, none = toxicity.learn_words(one_label)
        assert words.isEmpty() and none == -math.inf
    assert toxicity.Restorer(model).words("a") == {"a"}


def test_a_task_holds_few_words_of_a_large_batch(monkeypatch):
    held, count = [], toxicity.count_trigrams
    monkeypatch.setattr(toxicity, "HELD_WORDS", 10)
    monkeypatch.setattr(toxicity, "count_trigrams", lambda words: held.append(len(words)) or count(words))
    texts = [" ".join("abcdefgh"[i % 8] * (j + 1) + "x" * i for j in range(4)) for i in range(200)] + [None]
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    (found,) = toxicity._counted_trigrams(iter([batch]))
    assert max(held) <= 10 + 4
    expected = count(Counter(w for t in texts if t for w in t.split()))
    assert dict(zip(*found.to_pydict().values())) == {c: n for c, n in enumerate(expected.tolist()) if n}


def test_remembered_readings_are_bounded_and_change_nothing(monkeypatch):
    monkeypatch.setattr(toxicity, "PLAIN_WORDS", 5)
    restorer = toxicity.Restorer(toxicity.CharModel([]))
    for text in ["ab cd ef gh", "ij kl mn op", "ab m0ron morooon й ab", "ab m0ron morooon й ab"] * 2:
        assert restorer.words(text) == toxicity.Restorer(restorer.model).words(text)
        assert len(restorer.plain) <= 5
