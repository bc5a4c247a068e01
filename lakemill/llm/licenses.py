"""License scans by patience alignment.

A region of a text is aligned with a license template: words that occur once in both are anchors, the longest
increasing subsequence of them is kept, and the gaps between anchors are aligned in the same way, where
other words have become unique.  Coverage is the share of the template's words that are aligned.

A region that covers a share c of a template's n words holds at least one of any floor((1 - c) n) + 1 of them.  So
that many words, the rarest in the text, place the regions: each occurrence puts the template where its own place in
it says.  A region is as long as the template and a quarter more on either side.

Defined cases: null and empty texts, and texts without a license, have no findings; every copy of a template is a
finding, the best (then first) region before those that do not overlap it; findings with the most aligned words are
named first, then by name and place; repeated rows have equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.license_texts import TEMPLATES

COVERAGE = 0.8
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_FOUND = "array<struct<license string, coverage double, start int, stop int, words int>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


def increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        below.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            piles.append(i)
        else:
            tops[pile], piles[pile] = value, i
    chain, i = [], piles[-1] if piles else -1
    while i >= 0:
        chain.append(i)
        i = below[i]
    return chain[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned positions (in the text, in the template), both increasing."""
    pairs, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(text[a:b], a) if in_text[w] == 1}
        shared = [(place[w], j) for j, w in enumerate(template[c:d], c) if in_template[w] == 1 and w in place]
        chain = [shared[i] for i in increasing([i for i, _ in shared])]
        if not chain:
            continue
        pairs += chain
        edges = [(a - 1, c - 1), *chain, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


def apart(regions: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """The best regions that do not overlap; of equally good ones the first."""
    kept: list[tuple[str, float, int, int, int]] = []
    # in order of start, none overlaps another
    starts: list[int] = []
    stops: list[int] = []
    for region in sorted(dict.fromkeys(regions), key=lambda f: -f[4]):
        at = bisect_left(starts, region[2])
        if (at == 0 or stops[at - 1] <= region[2]) and (at == len(starts) or region[3] <= starts[at]):
            starts.insert(at, region[2])
            stops.insert(at, region[3])
            kept.append(region)
    return kept


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = {name: words_of(text) for name, text in templates.items()}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = frozenset().union(*self.templates.values())

    def regions(self, places: dict[str, list[int]], template: list[str]) -> list[int]:
        """Where the template may begin in the text."""
        slack = int((1 - self.coverage) * len(template) + 1e-9)
        rarest = sorted(range(len(template)), key=lambda j: (len(places.get(template[j], ())), j))[: slack + 1]
        return sorted({i - j for j in rarest for i in places.get(template[j], ())})

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        words = words_of(text)
        places: dict[str, list[int]] = defaultdict(list)
        if self.vocabulary.isdisjoint(words):
            return []
        for i, word in enumerate(words):
            if word in self.vocabulary:
                places[word].append(i)
        found = []
        for name, template in self.templates.items():
            size, most = len(template), sum(min(n, len(places.get(w, ()))) for w, n in self.counts[name].items())
            if most < self.coverage * size:
                continue
            more, regions = size // 4, []
            for begin in self.regions(places, template):
                low = max(0, begin - more)
                pairs = align(words[low : begin + size + more], template)
                if len(pairs) >= self.coverage * size:
                    regions.append((name, len(pairs) / size, low + pairs[0][0], low + pairs[-1][0] + 1, len(pairs)))
            found += apart(regions)
        return sorted(found, key=lambda f: (-f[4], f[0], f[2]))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """Per row ``id`` and ``found``: license, coverage, word range and aligned words of each copy of a template."""

    @F.pandas_udf(_FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, coverage)
        names = ["license", "coverage", "start", "stop", "words"]
        for texts in batches:
            yield pd.Series([[dict(zip(names, f, strict=True)) for f in scanner.scan(t)] for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("id"), scan(F.col(text_col)).alias("found"))
