"""Language identification by rank-order profiles of frequent n-grams.

A profile is the list of a language's most frequent n-grams of one to three characters, words padded with a
blank on either side, learned from all labelled texts.  A document's own list is compared with
each profile: every n-gram costs the number of places it is out of place, at most the length of a profile.
The language of the smallest total is the prediction.

The score is 1 minus the distance over the largest possible one, so 0 means no n-gram in common.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is every text when
nothing could be learned; languages of equal distance go by name; n-grams of equal count go by their
text; repeated rows have equal results; rows with a null language teach nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import keep

PROFILE = 300
UNDETERMINED = "und"
#: Languages that may be learned; a table of profiles is at most this many times PROFILE rows.
MOST_LANGUAGES = 5000
#: Distinct words, and characters of them at most, that a task holds before it hands on their n-grams.
HELD_WORDS, HELD_CHARS = 100_000, 8_000_000
#: Words whose n-grams are spelled out at a time, and characters of a text.
WORDS_AT_ONCE, CHARS_AT_ONCE = 10_000, 1 << 20
_RUN = re.compile(r"[^\W\d_]+")
_BLANK = re.compile(r"\s")


def words_of(text: str) -> list[str]:
    words = _RUN.findall(text.lower())
    return words if text.isascii() else [w for w in words if w.isalpha() or any(map(str.isalpha, w))]


def parts_of(text: str) -> Iterator[str]:
    """A long text in parts that end at a blank."""
    start = 0
    while start < len(text):
        blank = _BLANK.search(text, start + CHARS_AT_ONCE)
        stop = blank.end() if blank else len(text)
        yield text[start:stop]
        start = stop


def ngram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of some words, each as a number that orders as its text, and the index of its word.

    The words stand in one line with a blank on either side of each; an n-gram with a blank in its middle or
    of a blank alone belongs to no word.
    """
    line = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    blank = line == 32
    word = np.cumsum(blank) - 1
    word[blank] -= 1  # a blank ends the word before it
    one, two = line << 42, (line[:-1] << 42) | (line[1:] << 21)
    three = (two[:-1] | line[2:])[~blank[1:-1]]
    of_two = np.where(blank[:-1], word[1:], word[:-1])
    codes = [one[~blank], two, three]
    return np.concatenate(codes), np.concatenate([word[~blank], of_two, word[1:-1][~blank[1:-1]]])


def code_of(gram: str) -> int:
    return sum(ord(c) << (42 - 21 * i) for i, c in enumerate(gram))


def gram_of(code: int) -> str:
    return "".join(chr(c) for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c)


def _added_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def count_ngrams(words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of counted words, in the order of their text, and how often each is there.

    Only ``WORDS_AT_ONCE`` words are spelled out at a time: what a task holds grows with the distinct n-grams.
    """
    distinct, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    left = iter(words.items())
    while part := list(islice(left, WORDS_AT_ONCE)):
        codes, word = ngram_codes([w for w, _ in part])
        own = _added_up(codes, np.fromiter((n for _, n in part), np.int64, len(part))[word])
        distinct, counts = _added_up(np.concatenate([distinct, own[0]]), np.concatenate([counts, own[1]]))
    return distinct, counts


def most_frequent(words: list[str]) -> np.ndarray:
    """Codes of a profile's n-grams, the most frequent first; equal counts in the order of the text."""
    if len(words) <= WORDS_AT_ONCE:
        distinct, counts = np.unique(ngram_codes(words)[0], return_counts=True)
    else:
        distinct, counts = count_ngrams(Counter(words))
    return distinct[np.argsort(-counts, kind="stable")[:PROFILE]]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: dict[str, Counter] = {}
    held = chars = 0

    def handed() -> Iterator[pd.DataFrame]:
        for lang, seen in words.items():
            codes, counts = count_ngrams(seen)
            if len(codes):
                yield pd.DataFrame({"lang": [lang] * len(codes), "code": codes, "n": counts})
        words.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            for part in parts_of(text):
                own, found = words.setdefault(lang, Counter()), words_of(part)
                before = len(own)
                own.update(found)
                new = len(own) - before
                # every new word is at most as long as the longest
                held, chars = held + new, chars + new * max(map(len, found), default=0)
                if held > HELD_WORDS or chars > HELD_CHARS:
                    yield from handed()
                    held = chars = 0
    yield from handed()


def learn_profiles(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``code`` (see :func:`gram_of`), ``rank`` (from 0), from every row that has a text and a language."""
    known = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = known.mapInPandas(_counted, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(
        F.sum("n").alias("n")
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ranked = counts.withColumn("place", place).where(F.col("place") <= PROFILE)
    return keep(ranked.select("lang", "code", (F.col("place") - 1).alias("rank")), "profiles")


class _Profiles:
    """Ranks of all languages as one matrix, a row per n-gram."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.codes = np.unique(np.array([code for _, code, _ in rows], np.int64))
        # the last row is for n-grams of no profile; -1: not in this profile
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        for lang, code, rank in rows:
            self.ranks[np.searchsorted(self.codes, code), at[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        words = [word for part in parts_of(text) for word in words_of(part)] if text else []
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        top = most_frequent(words)
        row = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        found = self.ranks[np.where(self.codes[row] == top, row, len(self.codes))]
        away = np.abs(found - np.arange(len(top))[:, None])
        distance = np.where(found < 0, PROFILE, away).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (PROFILE * len(top)))


def predict(docs: DataFrame, profiles: DataFrame, text_col: str, *kept: Column) -> DataFrame:
    """Per row the kept columns, ``lang_pred`` and ``score``."""
    languages = profiles.select("lang").distinct().count()
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages; profiles of at most {MOST_LANGUAGES} are sent to every executor")
    rows = [tuple(r) for r in profiles.select("lang", "code", "rank").collect()]
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("lang string, score double")
    def closest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Profiles(sent.value)
        for texts in batches:
            yield pd.DataFrame([known.predict(text) for text in texts], columns=["lang", "score"])

    found = docs.select(*kept, closest(F.col(text_col)).alias("_closest"))
    names = [c for c in found.columns if c != "_closest"]
    return found.select(*names, F.col("_closest.lang").alias("lang_pred"), F.col("_closest.score").alias("score"))


def identified(
    docs: DataFrame, profiles: DataFrame, text_col: str = "text", least_score: float = 0.2
) -> DataFrame:
    """The documents in some learned language, with all their columns.

    Texts without a letter go, and texts whose n-grams are so far out of place that the score is under
    ``least_score``.  Where nothing could be learned, all texts with a letter stay.
    """
    if profiles.isEmpty():
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    found = predict(docs, profiles, text_col, F.struct("*").alias("row"))
    return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)).select("row.*")
