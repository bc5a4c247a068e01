import random
from collections import Counter

from llm_cases import SCHEMA, frame, messy, sentence

from lakemill.llm import licenses
from lakemill.llm.license_texts import TEMPLATES


def lis_length(values):
    best = []
    for i, v in enumerate(values):
        best.append(1 + max([best[j] for j in range(i) if values[j] < v], default=0))
    return max(best, default=0)


def test_longest_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        values = rng.sample(range(40), rng.randrange(20))
        chain = licenses.increasing(values)
        picked = [values[i] for i in chain]
        assert chain == sorted(chain) and picked == sorted(picked) and len(chain) == lis_length(values)


def test_alignment_is_increasing_and_equal_words_only():
    rng = random.Random(2)
    for _ in range(300):
        a = sentence(rng, rng.randrange(30), 12).split()
        b = sentence(rng, rng.randrange(1, 30), 12).split()
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
        for word in set(a) & set(b):
            if a.count(word) == b.count(word) == 1 and len(set(a) & set(b)) == 1:
                assert len(pairs) == 1


def brute(text, templates, coverage=licenses.COVERAGE):
    """A region from every word of the text, without choosing rare words."""
    words, found = licenses.words_of(text), []
    for name, template in templates.items():
        template = licenses.words_of(template)
        size, best = len(template), None
        for begin in range(-size, len(words) + 1):
            low = max(0, begin - size // 4)
            region = words[low : max(0, begin + size + size // 4)]
            if not region:
                continue
            pairs = licenses.align(region, template)
            if len(pairs) >= coverage * size and (best is None or len(pairs) > best[0]):
                best = (len(pairs), name)
        if best:
            found.append((name, best[0]))
    return sorted(found, key=lambda f: (-f[1], f[0]))


def texts():
    rng = random.Random(3)
    out = []
    for name, text in TEMPLATES.items():
        words = text.split()
        noisy = [w for w in words if rng.random() > 0.05]
        out += [f"{sentence(rng, 30)} {text} {sentence(rng, 20)}", " ".join(noisy), f"{text}\n{sentence(rng, 9)}\n{text}"]
        out += [" ".join(words[: len(words) // 2]), text.upper() + name]
    return out + ["Released of the River under the sky, MIT is a License of sorts", "license", "", None, "版权 所有"]


def test_regions_from_rare_words_find_what_all_regions_find():
    scanner = licenses.Scanner(TEMPLATES)
    for text in texts():
        found = {f[0]: f[4] for f in scanner.scan(text)}
        everywhere = dict(brute(text, TEMPLATES))
        assert found.keys() <= everywhere.keys() and all(found[n] <= everywhere[n] for n in found)
        clear = {n for n, aligned in everywhere.items() if aligned >= 0.9 * len(licenses.words_of(TEMPLATES[n]))}
        assert clear <= found.keys(), text


def test_spans_and_coverage():
    text = "Some words first. Released under the MIT License. And more."
    assert licenses.Scanner(TEMPLATES).scan(text) == [("MIT notice", 1.0, 3, 8, 5)]


def test_query_over_rows(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts())] + messy()
    scanner = licenses.Scanner(TEMPLATES)
    found = licenses.scan_licenses(frame(spark, rows)).collect()
    assert Counter((r.id, str([tuple(f) for f in r.found])) for r in found) == Counter(
        (i, str(scanner.scan(t))) for i, t, *_ in rows
    )
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_copy_of_every_license_is_found():
    rng, names = random.Random(9), list(TEMPLATES)
    scanner = licenses.Scanner(TEMPLATES)
    for name in names:
        text = TEMPLATES[name]
        size = len(licenses.words_of(text))
        spans = [(f[2], f[3]) for f in scanner.scan(f"{text} {sentence(rng, 9)} {text} {text}") if f[0] == name]
        assert spans == [(0, size), (size + 9, 2 * size + 9), (2 * size + 9, 3 * size + 9)], name


def test_query_names_all_licenses(spark, tmp_path):
    from lakemill.llm.queries import QUERIES

    names = list(TEMPLATES)[:2]
    text = " filler ".join([TEMPLATES[n] for n in names] + [TEMPLATES[names[0]]])
    frame(spark, [(1, text, "en", "s"), (2, "none", "en", "s")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op3_license_scan"](spark, str(tmp_path)).collect()}
    assert set(names) <= {f.license for f in rows[1].found} and rows[2].found == [] and rows[2].n_licenses == 0
    assert sum(f.license == names[0] for f in rows[1].found) == 2
    assert rows[1].n_licenses == len({f.license for f in rows[1].found})
    assert (rows[1].license, rows[1].start, rows[1].stop) == tuple(rows[1].found[0][i] for i in (0, 2, 3))
