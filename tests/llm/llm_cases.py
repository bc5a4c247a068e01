"""Documents with the cases that every operator has to stand."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, id string, row string,"
    " words string, size string, hash string, score string"
)
NONE = [None] * 7


def frame(spark, rows, partitions=3):
    """rows: (doc_id, text, lang, source); columns whose names clash are filled with the text "clash"."""
    full = [(i, t, lang, s, None if t is None else len(t), *["clash"] * 7) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def sentence(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def messy(seed=5, copies=12):
    """Nulls in every column, empty and blank texts, one very long text, ties, copies and repeated rows."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(1, 60)) for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[3], "en", "s1") for i in range(copies)]
    rows += [(200, base[4].replace(" ", "  \t"), "en", None), (201, base[4].replace(" ", "\n \x0b"), None, "s2")]
    rows += [(300, None, None, None), (301, "", "en", "s1"), (302, " \t\r\n", "en", "s1"), (303, None, "en", "s0")]
    rows += [(400, sentence(rng, 5000, 400), "en", "s0"), (401, "Ünïcode ßtraße 日本語 é", "de", "s0")]
    rows += [(500, base[5], "en", "s2")] * 3
    rows += [(None, base[6], "en", "s1"), (None, "only without an id", "en", "s1")]
    return rows
