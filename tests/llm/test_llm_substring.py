import random
from collections import Counter
from hashlib import sha256

import pytest
from llm_cases import SCHEMA, frame, messy, sentence

from lakemill.llm import substring


def brute(rows, window=20):
    """Rows of one id and text are one document; equal ids are not otherwise used here."""
    docs = {(i is None, i or 0, t or ""): (t or "").encode().split() for i, t, *_ in rows}
    seen, out = set(), {}
    for key in sorted(docs):
        words, gone = docs[key], set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone |= set(range(s, s + window))
            seen.add(w)
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone)
        out[key] = (len(words), len(gone), sha256(kept).hexdigest(), kept.decode())
    return Counter((i, *out[i is None, i or 0, t or ""]) for i, t, *_ in rows)


def found(df, window=20, base=5):
    rows = substring.remove_repeats(df, window=window, base=base)
    return Counter(tuple(r) for r in rows.select("id", "n_words", "n_removed", "kept_sha256", "kept").collect())


def case(seed):
    rng = random.Random(seed)
    vocabulary = rng.choice([1, 2, 8, 300])
    passages = [sentence(rng, rng.randrange(15, 60), vocabulary) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(0, 30), vocabulary) for _ in range(2)]
        parts.insert(1, rng.choice([*passages, "", ""]))
        rows.append((i * 7 % 61, rng.choice([" ", "\n", " \t"]).join(parts), "en", "s"))
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_brute_force(spark, seed):
    rows = case(seed)
    assert found(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize(("window", "base"), [(8, 2), (3, 3), (12, 3)])
def test_other_lengths(spark, window, base):
    rows = case(2)
    assert found(frame(spark, rows), window, base) == brute(rows, window)


def test_messy_rows(spark):
    assert found(frame(spark, messy())) == brute(messy())


def test_small_batches_of_words(spark, monkeypatch):
    monkeypatch.setattr(substring, "HELD_WORDS", 30)
    rows = case(3) + messy()
    assert found(frame(spark, rows)) == brute(rows)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == Counter()


def test_lengths_are_doubled_until_nothing_repeats(spark):
    rng = random.Random(8)
    long, middle, short = sentence(rng, 90, 10**6), sentence(rng, 45, 10**6), sentence(rng, 21, 10**6)
    rows = [(1, f"a {long}", "en", "s"), (2, f"{long} b", "en", "s"), (3, f"c {middle}", "en", "s"), (4, middle, "en", "s")]
    rows += [(5, short, "en", "s"), (6, f"x {short}", "en", "s"), (7, sentence(rng, 200, 10**6), "en", "s"), (8, None, None, None)]
    longest = {r.id: r.words for r in substring.longest_repeats(frame(spark, rows)).collect()}
    assert longest == {1: 80, 2: 80, 3: 40, 4: 40, 5: 20, 6: 20}
