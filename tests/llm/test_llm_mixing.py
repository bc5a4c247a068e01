import random
import re
from collections import defaultdict

import pytest
from llm_cases import SCHEMA, frame, messy, sentence

from lakemill.llm import mixing


def quotients(votes, seats, most):
    """Highest quotients one seat at a time."""
    given = [0] * len(votes)
    for _ in range(min(seats, sum(most))):
        open_ = [i for i in range(len(votes)) if given[i] < most[i]]
        i = max(open_, key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[i] += 1
    return given


def test_sainte_lague_gives_the_highest_quotients():
    rng = random.Random(1)
    for _ in range(300):
        votes = [rng.choice([0, rng.randrange(1, 9), rng.randrange(1, 5000)]) for _ in range(rng.randrange(1, 9))]
        most = [rng.choice([10**6, rng.randrange(0, 40)]) for _ in votes]
        seats = rng.randrange(0, 120)
        found = mixing.sainte_lague(votes, seats, most)
        if sum(votes):
            assert list(found) == quotients(votes, seats, most), (votes, seats, most)


def targets(sizes):
    """Water filling by rounds over {source: words}."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] >= 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def corpus():
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randrange(1, 300)), "en", f"s{min(i % 9, 4)}") for i in range(400)]
    return rows + [(1000 + i, sentence(rng, 40), "en", None) for i in range(4)]


@pytest.mark.parametrize("rows", [corpus(), messy()], ids=["corpus", "messy"])
def test_targets_limits_and_sums(spark, rows):
    found = mixing.mix(frame(spark, rows), block_words=16, shard_words=2000).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in found) == sorted(
        (i is None, i or 0, words(t)) for i, t, *_ in rows
    )
    sizes, source = defaultdict(int), {}
    for i, t, _, s in rows:
        sizes[s] += words(t)
        source[i, words(t)] = s
    expected, taken = targets(sizes), defaultdict(int)
    for r in found:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(expected[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, target in expected.items():
        assert abs(taken[s] - target) <= 16 + 0.01 * target, (s, taken[s], target)


def test_reruns_agree_however_rows_are_split(spark):
    runs = [
        sorted(map(str, mixing.mix(frame(spark, corpus(), n), block_words=16, shard_words=2000).collect()))
        for n in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_no_rows_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    found = mixing.mix(frame(spark, [(1, None, None, None), (2, " ", "en", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in found] == [(0, 0.0, 0)] * 2


def test_mixed_documents_keep_their_columns(spark):
    df = frame(spark, messy())
    mixed = mixing.mixed_documents(df, block_words=16, shard_words=2000)
    assert mixed.select("row.*").columns == df.columns
    repeated = [r.mix.taken for r in mixed.where("row.doc_id = 500").collect()]
    assert len(repeated) <= 1


def test_small_sources_come_near_their_targets(spark):
    rng = random.Random(6)
    sizes = [1, 2, 5, 10, 20, 30, 40, 50, 63, 64, 65, 100, 150, 200]
    rows, doc = [], 0
    for i, size in enumerate(sizes):
        left = size
        while left:
            n = min(left, rng.randrange(1, 30))
            rows.append((doc, sentence(rng, n), "en", f"small {i:02d}"))
            left, doc = left - n, doc + 1
    rows += [(10_000 + i, sentence(rng, 2000), "en", "z large") for i in range(100)]
    found = mixing.mix(frame(spark, rows)).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = defaultdict(int), {}
    for r in found:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    for name, words_wanted in target.items():
        assert abs(taken[name] - words_wanted) <= 1, name


def test_cut_to_any_number_of_words():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        blocks = int(rng.integers(1, 8))
        lengths = rng.integers(1, 20, blocks)
        times = rng.integers(0, 4, blocks)
        wanted = int(rng.integers(0, 3 * lengths.sum() + 1))
        part = mixing._cut_to(wanted, times, lengths, rng.permutation(blocks), 3)
        assert (times * lengths + part).sum() == wanted
        assert (np.abs(part) < lengths).all() and ((times >= 0) & (times <= 3)).all()
        assert (times[part > 0] < 3).all() and (times[part < 0] > 0).all()
