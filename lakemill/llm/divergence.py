r"""Source divergence audit: how far the word use of each source is from the other sources of its language.

Terms are counted in Arrow: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by`` turn a few megabytes
of text at a time into partial counts, which Spark adds up per (language, source, term).  A language keeps the
terms that occur in at least ``LEAST_DOCS`` of its documents.  Every kept term has in each group a smoothed share

    p = 1 + floor(1000000000 * (count + 5) / (N + 5 * V))

of the N counted terms, V being the language's kept terms; shares are computed as exact decimals, differences as whole numbers.

Pairs of sources meet in shards: a shard holds the columns (sources) of a square tile of at most about twice ``TILE_SOURCES``
sources, and about ``SHARD_TERMS`` terms as rows.  It sums |p - q| of each pair of its columns over the terms it
holds; the other terms occur in neither source, where the difference is the same for all and is added in one
product.  A language of many sources has many tiles, one of many terms many shards, so no task holds a language.

Defined cases: null text, language and source are empty ones; a group without terms takes part with all counts 0; without
kept terms the pairs have value 0 and there are no terms; ties go by the item, in the order of its UTF-8; repeated
rows count each; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import filled, join_groups, keep

LEAST_DOCS = 30
TERM_RANKS = 50
#: Added to every count; what shares are parts of.
PRIOR, UNIT = 5, 1_000_000_000
#: Everything that is no ASCII letter and not beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Text counted at a time.
SLICE_BYTES = 8 << 20
SHARD_TERMS, TILE_SOURCES = 1024, 64

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_ARROW_COUNTS = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``SLICE_BYTES`` of text; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def count_terms(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Occurrences (``n``) and documents (``docs``) per language, source and term, and a row without a term per group."""
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=BETWEEN)
    row, term = pc.list_parent_indices(words), pc.list_flatten(words)
    # a separator at either end of a text leaves an empty word there
    full = pc.greater(pc.binary_length(term), 0)
    terms = pc.filter(term, full).dictionary_encode()
    langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    in_docs = pa.table({"row": pc.filter(row, full), "term": terms.indices}).group_by(["row", "term"]).aggregate(
        [([], "count_all")]
    )
    of = in_docs.column("row").combine_chunks()
    placed = pa.table({
        "lang": langs.indices.take(of), "source": sources.indices.take(of),
        "term": in_docs.column("term"), "n": in_docs.column("count_all"),
    })
    counted = placed.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
    groups = pa.table({"lang": langs.indices, "source": sources.indices}).group_by(["lang", "source"]).aggregate([])

    def spelled(values: pa.DictionaryArray, column: str) -> list[pa.Array]:
        return [values.dictionary.take(t.column(column).combine_chunks()) for t in (counted, groups)]

    none = len(groups)
    columns = [
        pa.concat_arrays(spelled(langs, "lang")),
        pa.concat_arrays(spelled(sources, "source")),
        pa.concat_arrays([terms.dictionary.take(counted.column("term").combine_chunks()), pa.nulls(none, pa.string())]),
        *(
            pa.concat_arrays([counted.column(c).combine_chunks().cast(pa.int64()), pa.array([0] * none, pa.int64())])
            for c in ("n_sum", "n_count")
        ),
    ]
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _ARROW_COUNTS.types)], schema=_ARROW_COUNTS)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            yield count_terms(part)


def _share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, exactly: products do not fit into 64 bits."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    below = (total + PRIOR * kept).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


_TILE = "lang string, source string, item string, kept bigint, apart bigint, delta bigint"
_ARROW_TILE = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
    ("kept", pa.int64()), ("apart", pa.int64()), ("delta", pa.int64()),
])


def _compared(shard: pa.Table) -> pa.Table:
    """``delta`` of each pair of a tile: what the terms of this shard add to those that occur in neither source."""
    marks = shard.filter(pc.is_null(shard.column("term")))
    cells = shard.filter(pc.is_valid(shard.column("term")))
    names = marks.column("source").combine_chunks()
    none, block = (marks.column(c).to_numpy() for c in ("p", "block"))
    terms = cells.column("term").combine_chunks().dictionary_encode()
    shares = np.repeat(none[:, None], max(1, len(terms.dictionary)), axis=1)
    column = pc.index_in(cells.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
    shares[column, terms.indices.to_numpy(zero_copy_only=False)] = cells.column("p").to_numpy()
    first, second = (marks.column(c)[0].as_py() for c in ("tile_a", "tile_b"))
    left, right = np.nonzero(block == first)[0], np.nonzero(block == second)[0]
    out = [[], [], [], []]
    for i in left:
        others = right[right > i] if first == second else right
        apart = np.abs(none[others] - none[i])
        delta = np.abs(shares[others] - shares[i]).sum(axis=1) - apart * shares.shape[1]
        for a, b in ((np.full(len(others), i), others), (others, np.full(len(others), i))):
            for values, new in zip(out, (a, b, apart, delta), strict=True):
                values.append(new)
    a, b, apart, delta = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)
    return pa.table([
        pa.array([marks.column("lang")[0].as_py()] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)),
        pa.array([marks.column("kept")[0].as_py()] * len(a), pa.int64()), pa.array(apart), pa.array(delta),
    ], schema=_ARROW_TILE)


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``value`` of each ordered pair of sources of a language."""
    shards = F.greatest(F.lit(1), F.ceil(F.col("kept") / SHARD_TERMS)).cast("bigint")
    blocks = F.ceil(F.col("n_sources") / TILE_SOURCES).cast("bigint")
    common = ["lang", "source", "kept", "block", "blocks"]
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block")
    placed = cells.withColumns({"blocks": blocks, "shard": F.pmod(F.xxhash64("term"), shards)}).select(
        "lang", "source", "kept", block, "blocks", "shard", "term", "p"
    )
    # every shard knows all sources of its tile, those without a term of it too
    marks = groups.withColumns({"blocks": blocks, "shard": F.explode(F.sequence(F.lit(0), shards - 1))}).select(
        "lang", "source", "kept", block, "blocks", "shard", F.lit(None).cast("string").alias("term"), F.col("none").alias("p")
    )
    tiles = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("tile_a"), F.greatest("block", other).alias("tile_b")),
    )
    tiled = placed.unionByName(marks).withColumn("tile", F.explode(tiles)).select(
        *[c for c in common if c != "blocks"], "shard", "term", "p", "tile.*"
    )
    compared = tiled.groupBy("lang", "shard", "tile_a", "tile_b").applyInArrow(_compared, _TILE)
    return compared.groupBy("lang", "source", "item").agg(
        (F.sum("delta") + F.max("kept") * F.max("apart")).alias("value")
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    ranks: int = TERM_RANKS,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: every other source of the language by its distance, the sum of |p - q| over all kept terms.  Part
    ``term``: the ``ranks`` terms whose share in the source is most above their share in the language.
    """
    texts = docs.select(*(filled(F.col(c).cast("string")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    counts = keep(
        texts.mapInArrow(_partial, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts",
    )
    terms = counts.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).where(
        F.col("docs") >= least_docs
    )
    cells = keep(terms.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "cells")
    per_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("size"))
    # a kept term has its language's count in each of its cells, so one of them speaks for it
    per_lang = cells.groupBy("lang", "term").agg(F.max("in_lang").alias("n")).groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count("*").alias("kept")
    )
    every = counts.where(F.col("term").isNull()).select("lang", "source")
    sources = every.groupBy("lang").agg(F.count("*").alias("n_sources"))
    facts = sources.join(per_lang, "lang", "left").na.fill(0, ["lang_total", "kept"])
    groups = join_groups(every, facts, ["lang"], "n_sources", F.xxhash64("source"))
    groups = groups.join(per_group, ["lang", "source"], "left").na.fill(0, ["total", "size"])
    none = F.when(F.col("kept") > 0, _share(F.lit(0).cast("bigint"), F.col("total"), F.col("kept"))).otherwise(0)
    groups = keep(groups.withColumn("none", none), "groups")
    known = groups.select("lang", "source", "total", "lang_total", "kept", "n_sources", "size")
    shared = join_groups(cells, known, ["lang", "source"], "size", F.xxhash64("term"))
    shared = keep(shared.select(
        "lang", "source", "term", "kept", "n_sources",
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q"),
    ), "shares")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = _pairs(shared.drop("q"), groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", place)
    above = shared.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = above.select("*", place).where(F.col("rank") <= ranks)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
