r"""Substring deduplication by level-wise doubling.

A window of 20 words can only repeat if every shorter window inside it does.  So windows of 5 words are looked
at first, then of 10, then of 20; only stretches whose windows repeat at one length go on to twice that
length.  Below the full length it is enough to look at one window of each 20 words: the one with the
smallest hash, which equal stretches choose alike.  Hashes of twice the length are made from two
halves.  Rows of one hash meet only in sums and minima, which map tasks reduce first, so a window that a
third of all documents share is one row per task.

Equal texts are looked at once, as the one of the smallest id: all windows of its copies start earlier there.
At 20 words the first place (id, text hash, start) of every distinct window stays; words under any
other window go.  :func:`longest_repeats` doubles on, until no candidates survive.

Words are runs of other characters than blanks (space, tab to carriage return), compared byte by byte through
128-bit hashes (a window by two of 64 bits, a text by MD5; which texts windows belong to is told by 64 bits, where a
collision could only leave a repeat in place).  Defined cases: null and empty texts have no words; texts of fewer words
than a window lose none; documents of equal id are ordered by a hash of their text; a null id comes last;
rows that repeat id and text are one document and have the same result; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import filled, join_groups, keep

WINDOW_WORDS = 20
BASE_WORDS = 5
#: Words that a task holds in arrays at a time; a longer text is held alone.
HELD_WORDS = 100_000
#: Distinct words whose hashes a task remembers.
REMEMBERED = 150_000
_LAST = (1 << 63) - 1
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _K1 + right
    mixed ^= mixed >> np.uint64(29)
    mixed *= _K2
    return mixed ^ (mixed >> np.uint64(32))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position; even lengths are made from two halves."""
    if len(words) < length:
        return words[:0]
    if length == 1:
        return words
    if length % 2:
        rest = window_hashes(words, length - 1)
        return _joined(rest[: len(words) - length + 1], words[length - 1 :])
    half = window_hashes(words, length // 2)
    return _joined(half[: len(words) - length + 1], half[length // 2 :])


class _Texts:
    """Some rows' words one after another, and the starts of all windows inside rows."""

    def __init__(self, rows: list, words: list[bytes], sizes: list[int], window: int):
        self.rows, self.words = rows, words
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.row = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(words))
        self.starts = at[at + window <= self.ends[self.row]] if len(words) else at

    def anchors(self, hashes: np.ndarray, length: int, window: int) -> np.ndarray:
        """For each window start the position of its smallest hash, the first of equal ones."""
        span = window - length + 1
        if span == 1 or not len(self.starts):
            return self.starts
        return self.starts + np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(axis=1)[self.starts]

    def places(self, positions: np.ndarray) -> pd.DataFrame:
        """Document and position in it."""
        row = self.row[positions]
        of = {c: np.array([getattr(r, c) for r in self.rows], np.int64) for c in ("id", "k", "base")}
        return pd.DataFrame(
            {"id": of["id"][row], "k": of["k"][row], "pos": of["base"][row] + positions - self.begins[row]}
        )

    def marked(self, column: str) -> np.ndarray:
        """Which words are at the listed positions of their document."""
        found = np.zeros(len(self.words) + 1, bool)
        for i, row in enumerate(self.rows):
            listed = getattr(row, column)
            if listed is not None:
                own = np.asarray(listed, np.int64) - row.base + self.begins[i]
                found[own[(own >= self.begins[i]) & (own < self.ends[i])]] = True
        return found

    def runs(self, starts: np.ndarray, window: int) -> Iterator[tuple[int, int, int]]:
        """(row, from, to) of the words under the windows from these starts."""
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        covered = np.cumsum(change)[:-1] > 0
        edges = covered.astype(np.int8)
        opens = covered & (np.concatenate([[0], edges[:-1]]) == 0)
        opens[self.begins[self.begins < len(covered)]] |= covered[self.begins[self.begins < len(covered)]]
        closes = np.concatenate([opens[1:] | (edges[1:] == 0), [True]]) & covered
        for a, b in zip(np.flatnonzero(opens), np.flatnonzero(closes) + 1, strict=True):
            yield int(self.row[a]), int(a), int(b)


def _texts(batches: Iterable[pd.DataFrame], window: int) -> Iterator[_Texts]:
    rows, words, sizes = [], [], []
    for batch in batches:
        for row in batch.itertuples(index=False):
            own = row.words.split()
            if len(own) < window:
                continue
            rows.append(row)
            words += own
            sizes.append(len(own))
            if len(words) >= HELD_WORDS:
                yield _Texts(rows, words, sizes, window)
                rows, words, sizes = [], [], []
    if rows:
        yield _Texts(rows, words, sizes, window)


def _anchor_rows(length: int, window: int):
    def run(batches):
        known = _WordHashes(1)
        for texts in _texts(batches, window):
            hashes = window_hashes(known.of(texts.words), length)
            chosen = np.unique(texts.anchors(hashes, length, window))
            yield texts.places(chosen)[["k", "pos"]].assign(hash=hashes[chosen].view(np.int64))

    return run


def _surviving_rows(length: int, window: int):
    def run(batches):
        known = _WordHashes(1)
        for texts in _texts(batches, window):
            anchors = texts.anchors(window_hashes(known.of(texts.words), length), length, window)
            alive = texts.starts[~texts.marked("single")[anchors]]
            found = [
                (texts.rows[r].id, texts.rows[r].k, texts.rows[r].base + a - int(texts.begins[r]), b" ".join(texts.words[a:b]))
                for r, a, b in texts.runs(alive, window)
            ]
            yield pd.DataFrame(found, columns=["id", "k", "base", "words"])

    return run


_STRETCHES = "id bigint, k bigint, base bigint, words binary"


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"),
        F.xxhash64(filled(text_col)).alias("k"),
        filled(text_col).cast("binary").alias("words"),
        F.struct("*").alias("row"),
    )


def _whole(rows: DataFrame) -> DataFrame:
    """Texts as stretches from their first word."""
    return rows.select("id", "k", F.lit(0).cast("bigint").alias("base"), "words")


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per text, under the smallest id."""
    return _whole(rows.groupBy("k").agg(F.min("id").alias("id"), F.first("words").alias("words")))


def survivors(every: DataFrame, stretches: DataFrame, length: int, window: int) -> DataFrame:
    """The parts of stretches under windows that may repeat, judged by windows of ``length`` words inside them.

    ``every`` holds the same stretches and may repeat those of equal texts.
    """
    chosen = every.mapInPandas(_anchor_rows(length, window), "k bigint, pos bigint, hash bigint")
    place = [F.min("k").alias("k"), F.max("k").alias("k_last"), F.min("pos").alias("pos"), F.max("pos").alias("last")]
    single = chosen.groupBy("hash").agg(*place).where("k = k_last AND pos = last")
    by_text = single.groupBy("k").agg(F.collect_list(F.col("pos").cast("int")).alias("single"))
    joined = stretches.join(by_text, "k", "left")
    return keep(joined.mapInPandas(_surviving_rows(length, window), _STRETCHES), "stretches")


def candidates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, base: int = BASE_WORDS
) -> DataFrame:
    """Stretches that have survived all lengths below ``window``, which is ``base`` doubled some times."""
    rows = _identified(docs, id_col, text_col)
    every, stretches, length = _whole(rows), _distinct(rows), base
    while length < window:
        every = stretches = survivors(every, stretches, length, window)
        length *= 2
    if length != window:
        raise ValueError(f"{window} is not {base} doubled")
    return stretches


def longest_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, base: int = BASE_WORDS
) -> DataFrame:
    """Per distinct text (smallest ``id``, null ids as the largest number) the longest length, ``window`` doubled some
    times, at which one of its windows repeats in it or in another text; texts without any are left out."""
    stretches, length, found = candidates(docs, id_col, text_col, window, base), window, []
    while True:
        stretches = survivors(stretches, stretches, length, length)
        if stretches.isEmpty():
            break
        found.append(stretches.select("id", "k", F.lit(length).alias("words")))
        length *= 2
    if not found:
        return stretches.select("id", "k", F.lit(0).alias("words"))
    everything = found[0]
    for more in found[1:]:
        everything = everything.unionByName(more)
    return everything.groupBy("id", "k").agg(F.max("words").alias("words"))


def _window_rows(window: int):
    def run(batches):
        one, two = _WordHashes(1), _WordHashes(2)
        for texts in _texts(batches, window):
            a = window_hashes(one.of(texts.words), window)[texts.starts]
            b = window_hashes(two.of(texts.words), window)[texts.starts]
            yield texts.places(texts.starts).assign(a=a.view(np.int64), b=b.view(np.int64))

    return run


def _removed_rows(window: int):
    def run(batches):
        for texts in _texts(batches, window):
            again = texts.starts[~texts.marked("first")[texts.starts]]
            found = []
            for r, a, b in texts.runs(again, window):
                row, shift = texts.rows[r], texts.rows[r].base - int(texts.begins[r])
                found.append((row.id, row.k, a + shift, b + shift))
            yield pd.DataFrame(found, columns=["id", "k", "start", "stop"])

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, base: int = BASE_WORDS
) -> DataFrame:
    """Word ranges (``id``, ``k``, ``start``, ``stop``) under windows whose words also start earlier.

    Of equal texts only the one of the smallest id is listed.
    """
    stretches = candidates(docs, id_col, text_col, window, base)
    windows = stretches.mapInPandas(_window_rows(window), "id bigint, k bigint, pos bigint, a bigint, b bigint")
    first = windows.groupBy("a", "b").agg(F.min(F.struct("id", "k", "pos")).alias("first")).select("first.*")
    by_document = first.groupBy("id", "k").agg(F.collect_list(F.col("pos").cast("int")).alias("first"))
    joined = stretches.join(by_document, ["id", "k"], "left")
    return joined.mapInPandas(_removed_rows(window), "id bigint, k bigint, start bigint, stop bigint")


def copies(rows: DataFrame) -> DataFrame:
    """(``id``, ``k``) of the documents whose whole text an earlier document has."""
    hashed = rows.select("id", "k", F.unhex(F.md5("words")).alias("text"))
    first = hashed.groupBy("text").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = join_groups(hashed, keep(first, "copies"), ["text"], "n", F.xxhash64("id"))
    return joined.where(F.col("id") > F.col("first")).select("id", "k").distinct()


def _kept(window: int):
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, copied, starts, stops in batches:
            rows = []
            for text, copy, begin, end in zip(texts, copied, starts, stops, strict=True):
                words = bytes(text).split()
                total = len(words)
                if copy and total >= window:
                    words = []
                elif begin is not None:
                    for a, b in sorted(zip(begin, end, strict=True), reverse=True):
                        del words[a:b]
                kept = b" ".join(words)
                rows.append((total, total - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, base: int = BASE_WORDS
) -> DataFrame:
    """Per input row: ``row``, ``id``, ``n_words``, ``n_removed``, ``kept_sha256`` and the ``kept`` words, joined by blanks."""
    rows = _identified(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, window, base).groupBy("id", "k").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans")
    )
    marks = spans.withColumn("copied", F.lit(False)).unionByName(
        copies(rows).withColumn("copied", F.lit(True)), allowMissingColumns=True
    )
    kept = F.pandas_udf(
        _kept(window), "n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    )
    joined = rows.join(marks, ["id", "k"], "left")
    copied = F.coalesce("copied", F.lit(False))
    done = joined.withColumn("done", kept("words", copied, F.col("spans.start"), F.col("spans.stop")))
    return done.select("row", F.col("row")[id_col].alias("id"), "done.*")
