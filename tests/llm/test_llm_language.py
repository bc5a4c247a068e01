import random
import tracemalloc
from collections import Counter

import pandas as pd
from llm_cases import SCHEMA, frame, messy
from pyspark.sql import functions as F

from lakemill.llm import language

TEXTS = {
    "en": "the cat and the dog sat on the mat with this and that other thing in the house",
    "de": "der hund und die katze sind nicht auf dem tisch sondern unter der bank im haus",
    "fr": "le chat et le chien ne sont pas sur la table mais sous le banc dans la maison",
}
ROWS = [(i * 10 + j, " ".join(t.split()[j:]), lang, "s") for i, (lang, t) in enumerate(TEXTS.items()) for j in range(5)]


def grams(text):
    words = ["".join(c if c.isalpha() else " " for c in text.lower())][0].split()
    found = Counter()
    for w in words:
        p = f" {w} "
        for n in (1, 2, 3):
            found.update(g for g in (p[i : i + n] for i in range(len(p) - n + 1)) if g != " ")
    return [g for g, _ in sorted(found.items(), key=lambda x: (-x[1], x[0]))[: language.PROFILE]]


def brute(rows, queries):
    profiles = {}
    for lang in sorted({r[2] for r in rows if r[2] is not None and r[1] is not None}):
        joined = " | ".join(t for _, t, x, _ in rows if x == lang and t is not None)
        profiles[lang] = {g: i for i, g in enumerate(grams(joined))}
    out = []
    for i, text, *_ in queries:
        own = grams(text or "")
        if not own:
            out.append((i, "und", 0.0))
            continue
        most = language.PROFILE
        totals = {
            lang: sum(abs(n - p[g]) if g in p else most for n, g in enumerate(own)) for lang, p in profiles.items()
        }
        best = min(totals, key=lambda lang: (totals[lang], lang))
        out.append((i, best, round(1 - totals[best] / (most * len(own)), 9)))
    return sorted(out, key=str)


def predicted(df, profiles):
    found = language.predict(df, profiles, "text", F.col("doc_id")).collect()
    return sorted(((r.doc_id, r.lang_pred, round(r.score, 9)) for r in found), key=str)


def test_brute_force(spark):
    profiles = language.learn_profiles(frame(spark, ROWS))
    queries = ROWS + messy()
    assert predicted(frame(spark, queries), profiles) == brute(ROWS, queries)


def test_learning_from_messy_rows(spark):
    rows = ROWS + messy()
    profiles = language.learn_profiles(frame(spark, rows))
    assert predicted(frame(spark, rows), profiles) == brute(rows, rows)


def test_texts_without_letters_are_undetermined(spark):
    profiles = language.learn_profiles(frame(spark, ROWS))
    rows = [(1, None, None, None), (2, "", None, None), (3, "12 34 _ %%", None, None), (4, "½ ² Ⅷ", None, None)]
    assert {r[1:] for r in predicted(frame(spark, rows), profiles)} == {("und", 0.0)}


def test_no_rows_or_nothing_learned(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nothing = language.learn_profiles(empty)
    assert predicted(empty, nothing) == []
    assert predicted(frame(spark, ROWS[:1]), nothing) == [(0, "und", 0.0)]
    assert language.identified(frame(spark, [*ROWS, (99, "77", "en", "s")]), nothing).count() == len(ROWS)


def test_documents_of_a_language_stay(spark):
    df = frame(spark, [*ROWS, (98, "", "en", "s"), (99, "%% 12", "en", "s"), (97, "ЖЩЮ ЂЃ ЖЖЖ", "en", "s")])
    kept = language.identified(df, language.learn_profiles(frame(spark, ROWS)))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in ROWS)


def test_parts_of_a_text_hold_its_words(monkeypatch):
    text = "Ein Haus\u2003und  noch\neins, ΟΔΥΣΣΕΥΣ Σ " + "x" * 50 + " so"
    for size in (1, 3, 10, 1000):
        monkeypatch.setattr(language, "CHARS_AT_ONCE", size)
        parts = list(language.parts_of(text))
        assert "".join(parts) == text
        assert [w for p in parts for w in language.words_of(p)] == language.words_of(text)
    assert list(language.parts_of("")) == []


def test_ngrams_of_many_words_are_counted_in_pieces(monkeypatch):
    rng = random.Random(1)
    words = Counter({"".join(rng.choices("abcdeäö", k=rng.randrange(1, 9))): rng.randrange(1, 50) for _ in range(500)})
    plain = Counter()
    for word, n in words.items():
        padded = f" {word} "
        for size in (1, 2, 3):
            grams = [padded[i : i + size] for i in range(len(padded) - size + 1)]
            plain.update({g: n * c for g, c in Counter(g for g in grams if g.strip()).items()})
    for size in (1, 7, 10_000):
        monkeypatch.setattr(language, "WORDS_AT_ONCE", size)
        codes, counts = language.count_ngrams(words)
        assert {language.gram_of(int(c)): int(n) for c, n in zip(codes, counts, strict=True)} == plain


def test_a_task_counts_in_bounded_memory():
    """200,000 distinct words and one very long text take under 100 MB beside the text itself."""
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(2000)) for _ in range(100)]
    texts.append(" ".join(texts[:50]))
    batch = pd.DataFrame({"lang": "en", "text": texts})
    tracemalloc.start()
    try:
        rows = sum(len(part) for part in language._counted(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows and peak < 100 << 20
