"""Toxicity by noisy-channel deobfuscation.

A writer's word went through a channel that may replace letters by look-alikes (``m0r0n``), put separators
between letters (``m o r o n``, ``m.o.r.o.n``, also wider gaps), repeat letters (``morooon``) and put decoration around
(``moron!!!``).  Every written token is a lattice of the letters it may stand for, each with a channel cost; Viterbi finds
the cheapest path under a character trigram model of the corpus.  Nothing is cut off before: decoration is a path that
leaves out an outer run, at a cost, and tokens wholly of look-alikes (``4$$``, numbers too) are decoded as well.
Look-alikes are read in the script of most of a token's letters, Latin where it has none; in scripts without a table here
they stand for themselves.
A token of plain letters of one script has one path, itself.  A word split into pieces of several letters stays split.

The restored words are scored by a Bernoulli naive Bayes model over all words of the labelled rows: log-odds
towards either label are smoothed and shrunk by the positive-part rule 1 - DOUBT^2 / deviance, so a word weighs what its
rows support: one that chance explains nothing, one of seven toxic rows alone, beside as many clean ones, something.
Counts come from all labelled rows given, those of the language model from all texts.

Defined cases: null and empty texts have no words and get the score of such a text; rows without a label
teach nothing, nor do null labels; without rows of both labels every score is 0; repeated rows
have equal scores.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import keep

# Characters that stand for letters.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
}
# Characters that stand for Cyrillic letters.
CYRILLIC_LOOKALIKES = {
    "0": "о", "1": "ил", "3": "зэ", "4": "ч", "6": "б", "8": "в", "9": "я", "@": "а", "!": "и", "*": "аеиоу",
    "a": "а", "b": "в", "c": "с", "e": "е", "h": "н", "k": "к", "m": "м", "o": "о", "p": "р", "t": "т", "x": "х", "y": "у",
}
# Letters and the word's edge, then every other character.
ALPHABET = " abcdefghijklmnopqrstuvwxyzабвгдежзийклмнопрстуфхцчшщъыьэюя?"
#: Words whose weights are broadcast, those in most rows; weights of all others reach their rows by a join.
FREQUENT_WORDS = 100_000
#: Root of the deviance at which a word's log-odds shrink to zero.
DOUBT = 3.0
#: Distinct words that a task counts at a time.
HELD_WORDS = 50_000
#: Tokens that a task remembers as words that read as they are written, and those that it remembers another reading of.
PLAIN_WORDS = 200_000
DECODED = 32_768

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_LOOK = re.escape("".join(LOOKALIKES))
_CHAR = rf"(?:[^\W\d_]|[{_LOOK}])"
# single characters with the same gap between them, at least three
_SPACED = re.compile(rf"(?<![^\W_]){_CHAR}(([ ._\-*])\2{{0,3}})(?:{_CHAR}\1)+{_CHAR}(?![^\W_])")
# all digits and letters are among a word's characters; underscores are blanks by then
_TOKEN = re.compile(r"[\w" + re.escape("".join(c for c in LOOKALIKES if not c.isalnum())) + "]+")
_TRIPLE = re.compile(r"(.)\1\1")
_RUN = re.compile(r"(.)\1*", re.S)
# decoration: marks that often stand before or after a word
_BEFORE, _AFTER = frozenset("*(<+"), frozenset("!|*(<+")

_COST_LOOKALIKE = 1.0
_COST_KEPT = 9.0
_COST_HALVED = 4.0
_COST_REPEAT = 0.5
_COST_EDGE = 2.0
_COST_DECORATION = 1.0
_COST_DROPPED = 7.0


def _folded(token: str) -> str:
    """Without accents."""
    if token.isascii():
        return token
    return "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))


def written_tokens(text: str) -> tuple[list[str], list[str]]:
    """Tokens in lower case: ordinary ones, and those written letter by letter, without their gaps."""
    text = text.lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
    spelled = []

    def take(match: re.Match) -> str:
        spelled.append(match.group().replace(match.group(1), ""))
        return " "

    return _TOKEN.findall(_SPACED.sub(take, text).replace("_", " ")), spelled


_LETTERS = {c: i for i, c in enumerate(ALPHABET)}


def _letter(c: str) -> int:
    return _LETTERS.get(c, len(ALPHABET) - 1)


def _scripts(token: str) -> tuple[int, int, int]:
    """Letters of a token that are Latin, Cyrillic and other ones."""
    latin = sum("a" <= c <= "z" for c in token)
    cyrillic = sum("\u0400" <= c <= "\u052f" for c in token)
    return latin, cyrillic, sum(map(str.isalpha, token)) - latin - cyrillic


def _table(token: str) -> dict[str, str]:
    """What the characters of a token may stand for, by the script of most of its letters."""
    latin, cyrillic, other = _scripts(token)
    if other > max(latin, cyrillic):
        return {}
    return CYRILLIC_LOOKALIKES if cyrillic > latin else LOOKALIKES


class CharModel:
    """Costs (negative logarithms) of a character after two others."""

    def __init__(self, counts: Iterable[tuple[int, int]]):
        size = len(ALPHABET)
        flat = np.zeros(size**3)
        for code, n in counts:
            flat[code] = n
        three = flat.reshape(size, size, size)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        single = (one + 1) / (one.sum() + size)
        after_one = (two + 5 * single) / (two.sum(axis=1, keepdims=True) + 5)
        after_two = (three + 5 * after_one[None]) / (three.sum(axis=2, keepdims=True) + 5)
        self.cost = (-np.log(after_two)).tolist()

    @staticmethod
    def code(a: str, b: str, c: str) -> int:
        size = len(ALPHABET)
        return (_letter(a) * size + _letter(b)) * size + _letter(c)

    def restore(self, token: str, spaced: bool = False) -> str:
        """The cheapest path through the token's lattice; with ``spaced`` it may hold several words."""
        cost = self.cost
        # (two letters before) -> (cost so far, restored text)
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for letters, price in _lattice(token, spaced):
            reached: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (so_far, text) in states.items():
                for letter, extra in zip(letters, price, strict=True):
                    x, y, total = a, b, so_far + extra
                    for c in letter:
                        z = _letter(c)
                        total += cost[x][y][z]
                        x, y = y, z
                    best = reached.get((x, y))
                    if best is None or total < best[0]:
                        reached[x, y] = (total, text + letter)
            states = reached
        return min((total + cost[a][b][0], text) for (a, b), (total, text) in states.items())[1]


def _lattice(token: str, spaced: bool) -> Iterator[tuple[list[str], list[float]]]:
    """Per run of a character what it may stand for, and the channel's cost of that."""
    runs = [m.group() for m in _RUN.finditer(token)]
    table = _table(token)
    for i, run in enumerate(runs):
        base = [(c, _COST_LOOKALIKE) for c in table.get(run[0], "")]
        base.append((run[0], _COST_KEPT if base else 0.0))
        options: dict[str, float] = {}
        for c, price in base:
            if len(run) == 1:
                options[c] = price
            else:
                options[c] = price + (_COST_HALVED if len(run) == 2 else _COST_REPEAT)
                options[c + c] = price
        if spaced and i:
            options |= {" " + c: price + _COST_EDGE for c, price in options.items()}
        outer = 0 < i == len(runs) - 1, 0 == i < len(runs) - 1
        if not spaced and any(outer) and not run[0].isalpha():
            marks = run[0] in (_AFTER if outer[0] else _BEFORE) or (len(run) > 2 and not run[0].isdigit())
            options[""] = _COST_DECORATION if marks else _COST_DROPPED
        yield list(options), list(options.values())


class Restorer:
    """Restores texts, remembering the tokens it has decoded."""

    def __init__(self, model: CharModel):
        self.model = model
        self.plain: set[str] = set()
        self.decode = lru_cache(maxsize=DECODED)(self._decode)

    def _decode(self, token: str, spelled: bool = False) -> tuple[str, ...]:
        token = _folded(token)
        if not spelled and token.isalpha() and not _TRIPLE.search(token):
            if token.isascii() or sum(map(bool, _scripts(token))) == 1:
                return (token,)
        return tuple(self.model.restore(token, spelled).split())

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a text."""
        if not text:
            return set()
        tokens, spelled = written_tokens(text)
        tokens = set(tokens)
        found = tokens & self.plain
        for token in tokens - found:
            read = (token,)
            if not (token.isascii() and token.isalpha()) or _TRIPLE.search(token):
                read = self.decode(token)
            if read == (token,):
                self.plain.add(token)
            found.update(read)
        if len(self.plain) > PLAIN_WORDS:
            self.plain.clear()
        return found.union(*(self.decode(t, True) for t in spelled))


_CODES = np.array([_letter(chr(i)) for i in range(0x500)])


def count_trigrams(words: Counter) -> np.ndarray:
    """Character trigrams of some words, each with its edges, as many times as the word is there."""
    padded = [f"  {_folded(word)} " for word in words]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    letters = _CODES[np.minimum(points, len(_CODES) - 1)]
    codes = (letters[:-2] * len(ALPHABET) + letters[1:-1]) * len(ALPHABET) + letters[2:]
    times = np.repeat(np.fromiter(words.values(), np.int64, len(padded)), sizes)
    ends = np.cumsum(sizes)
    times[ends - 1] = times[ends - 2] = 0  # no trigram begins at the last two characters
    return np.bincount(codes, times[:-2], len(ALPHABET) ** 3).astype(np.int64)


def _counted_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    total = np.zeros(len(ALPHABET) ** 3, np.int64)
    for batch in batches:
        for text in batch["text"]:
            if text := text.as_py():
                words.update(filter(str.isalpha, written_tokens(text)[0]))
                if len(words) > HELD_WORDS:
                    total += count_trigrams(words)
                    words.clear()
    if words:
        total += count_trigrams(words)
    found = np.flatnonzero(total)
    yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], ["code", "n"])


def learn_characters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts ``n`` of character trigrams (``code``) over the words of all texts; at most 60^3 rows."""
    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(_counted_trigrams, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    return keep(counted, "trigrams")


def char_model(characters: DataFrame) -> CharModel:
    return CharModel([tuple(r) for r in characters.select("code", "n").collect()])


def restored_words(docs: DataFrame, model: CharModel, text: Column) -> Column:
    """The distinct restored words of a text, sorted, with blanks between: 64-bit hashes, which do not compress, take more."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        restorer = Restorer(sent.value)
        for texts in batches:
            yield pa.array((" ".join(sorted(restorer.words(t.as_py()))) for t in texts), pa.string(), size=len(texts))

    return words(text)


def _each_word(words: str) -> Column:
    return F.explode(F.filter(F.split(words, " "), lambda w: w != ""))


def learn_words(
    labelled: DataFrame, words_col: str = "words", label_col: str = "toxic"
) -> tuple[DataFrame, float]:
    """Per word of the labelled rows the log-odds ``weight`` that it adds; and the log-odds of a text with none of them.

    ``n`` is the number of labelled rows with the word.  Without rows of both labels there are no words.
    """
    known = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(label_col).alias("label"), F.col(words_col).alias("words")
    )
    # the empty word, once in every row, counts the rows
    led = F.when(F.col("words") == "", "").otherwise(F.concat(F.lit(" "), "words"))
    counted = keep(
        known.select("label", F.explode(F.split(led, " ")).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").cast("double").alias("t"), F.sum(1 - F.col("label")).cast("double").alias("c")),
        "word-counts",
    )
    rows = counted.where("word = ''").first()
    toxic, clean = (rows["t"], rows["c"]) if rows else (0, 0)
    if not toxic or not clean:
        return counted.select("word", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("n")).limit(0), -math.inf
    counted = counted.where("word != ''")
    t, c = F.col("t"), F.col("c")
    p, q = (t + 0.5) / (toxic + 1), (c + 0.5) / (clean + 1)
    ratio = F.log(p / q)
    # deviance of the two by two table of word and label from independence
    rate = (t + c) / (toxic + clean)
    cells = [(t, toxic * rate), (c, clean * rate), (toxic - t, toxic * (1 - rate)), (clean - c, clean * (1 - rate))]
    deviance = 2 * sum(F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells)
    drawn = ratio * F.greatest(1 - DOUBT**2 / F.greatest(deviance, F.lit(1e-9)), F.lit(0.0))
    # the larger of the two rates comes down to the other one's drawn multiple
    p_drawn = F.when(drawn < 0, p).otherwise(q * F.exp(drawn))
    q_drawn = F.when(drawn < 0, p * F.exp(-drawn)).otherwise(q)
    absent = F.log((1 - p_drawn) / (1 - q_drawn))
    weighed = counted.select("word", drawn.alias("drawn"), absent.alias("absent"), (t + c).cast("bigint").alias("n"))
    # summed in whole steps, so that the sum does not depend on the order of rows
    step = 1 << 32
    missing = weighed.agg(F.sum(F.round(F.col("absent") * step).cast("decimal(30,0)"))).first()[0]
    words = weighed.select("word", (F.col("drawn") - F.col("absent")).alias("weight"), "n")
    return keep(words, "word-weights"), math.log(toxic / clean) + float(missing or 0) / step


def _frequent(words: DataFrame) -> tuple[DataFrame, bool]:
    """At most ``FREQUENT_WORDS`` words, and whether weights of others are left.

    All words with a weight where those are so few; else the words in most rows, down to a number of rows, with the
    weightless ones among them, which need no join then.
    """
    weighty = words.where("weight != 0")
    if weighty.count() <= FREQUENT_WORDS:
        return weighty, False
    level = F.floor(F.log2("n") * 16)
    total, least = 0, math.inf
    for r in sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += r["count"]
        if total > FREQUENT_WORDS:
            break
        least = r["level"]
    return words.where(level >= F.lit(float(least))), True


def score(rows: DataFrame, words: DataFrame, none: float, words_col: str = "words") -> DataFrame:
    """The rows with ``score``, the probability of label 1, in place of their words."""
    frequent, others_left = _frequent(words)
    sent = rows.sparkSession.sparkContext.broadcast({r["word"]: r["weight"] for r in frequent.collect()})

    @F.arrow_udf("struct<odds: double, others: string>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for batch in batches:
            odds, others = [], []
            # the words of one row at a time: those of a batch would be many times its text
            for text in batch:
                each = text.as_py().split(" ")
                odds.append(math.fsum(known.get(w, 0.0) for w in each))
                others.append(" ".join(w for w in each if w not in known) if others_left else "")
            columns = [pa.array(odds, pa.float64()), pa.array(others, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["odds", "others"])

    kept = [c for c in rows.columns if c != words_col]
    weighed = rows.select(*kept, weigh(words_col).alias("_w"))
    odds = F.col("_w.odds")
    if others_left:
        # stored, since it is read twice by numbers that reading again could change
        numbered = keep(weighed.withColumn("_row", F.monotonically_increasing_id()), "weighed")
        pairs = numbered.select("_row", _each_word("_w.others").alias("word")).join(words.where("weight != 0"), "word")
        sums = pairs.groupBy("_row").agg(F.sum("weight").alias("_rest"))
        weighed = numbered.join(sums, "_row", "left")
        odds = odds + F.coalesce("_rest", F.lit(0.0))
    total = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), odds + F.lit(none)))
    return weighed.select(*kept, F.round(1 / (1 + F.exp(-total)), 12).alias("score"))
