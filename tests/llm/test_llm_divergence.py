"""The audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from llm_cases import frame, messy, sentence

from lakemill.llm import divergence


def words_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(rows, least, ranks=50):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for _, _, lang, source in rows})
    for _, text, lang, source in rows:
        words = words_of(text)
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = [g for g in groups if g[0] == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        of_lang = shares(sum((counts[g] for g in own), Counter()))
        of = {g: shares(counts[g]) for g in own}
        for g in own:
            pairs = [(sum(abs(of[g][t] - of[o][t]) for t in kept), o[1]) for o in own if o != g]
            terms = [(of[g][t] - of_lang[t], t) for t in kept if counts[g][t] and of[g][t] > of_lang[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                ordered = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(*g, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least", [1, 3, 1000])
def test_audit(spark, least):
    rng = random.Random(2)
    rows = messy() + [(1000 + i, f"Größe {sentence(rng, 30, 90)} x{i % 9}Y-z", rng.choice(["en", "de", None]), f"s{i % 11}") for i in range(300)]
    rows += [(5000, "a " * 30_000, "de", "s1"), (5001, None, "de", "silent"), (5002, "123 !!", "fr", "alone")]
    assert found(divergence.audit(frame(spark, rows), least_docs=least)) == plain(rows, least)


def test_many_sources_and_terms_meet_in_tiles_and_shards(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_SOURCES", 3)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 20)
    rng = random.Random(4)
    rows = [(i, sentence(rng, 40, 150).replace("w", "word").translate({48 + d: chr(97 + d) for d in range(10)}), "en", f"s{rng.randrange(25)}") for i in range(400)]
    rows += [(1000 + i, "hot words here", "en", "s0") for i in range(200)]
    assert found(divergence.audit(frame(spark, rows), least_docs=5)) == plain(rows, 5)


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, total, kept = 9 * 10**17, 10**18, 12345
    row = spark.range(1).select(divergence._share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 10)
    texts = ["", "a" * 50, "", "bb", "c" * 9, "d", ""]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert [t for s in divergence._slices(batch) for t in s.column("text").to_pylist()] == texts


def test_no_documents(spark):
    assert found(divergence.audit(frame(spark, [], 1))) == []
