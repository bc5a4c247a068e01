"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every shard of a source (documents dealt out by a seeded hash) is a line of words cut into blocks of
equally many words.  Blocks go to sources, and within a source to its shards, by the highest quotients
words / (2 k + 1).  Each shard then takes all its blocks equally often, and a seeded choice of them
once more, until its quota is full.  Sources and shards are summaries: a row per source, and a row per
million words.  No group of documents is larger than a shard.  In a source of a single shard the last block is cut to
what is left of the target, so sources of fewer words than a block get theirs too.

Defined cases: a null text has no words and is taken 0 times; a null source is a source of its own, the
last.  Sources without words have target 0.  Repeated rows are separate documents.
No rows give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakemill.llm.common import WORD, filled, join_groups, keep

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
SEED = 17


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int]) -> np.ndarray:
    """Seats by the highest quotients votes / (2 k + 1), at most ``most`` each; ties go to the first."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    total = votes.sum()
    if total <= 0 or seats <= 0:
        return np.zeros(len(votes), np.int64)
    given = np.minimum(np.floor(votes * (seats / total) + 0.5).astype(np.int64), most)
    missing = min(int(seats), int(most.sum())) - int(given.sum())
    if missing > 0:
        queue = [(-votes[i] / (2 * given[i] + 1), i) for i in range(len(votes)) if given[i] < most[i]]
        heapq.heapify(queue)
        for _ in range(missing):
            _, i = heapq.heappop(queue)
            given[i] += 1
            if given[i] < most[i]:
                heapq.heappush(queue, (-votes[i] / (2 * given[i] + 1), i))
    elif missing < 0:
        queue = [(votes[i] / (2 * given[i] - 1), -i) for i in range(len(votes)) if given[i]]
        heapq.heapify(queue)
        for _ in range(-missing):
            _, i = heapq.heappop(queue)
            given[-i] -= 1
            if given[-i]:
                heapq.heappush(queue, (votes[-i] / (2 * given[-i] - 1), i))
    return given


def _apportioned(table: pd.DataFrame) -> pd.DataFrame:
    """Rows with ``votes``, ``most`` and the ``house`` they share, in the order of ``place``."""
    table = table.sort_values("place")
    table["quota"] = sainte_lague(table["votes"], int(table["house"].iloc[0]), table["most"])
    return table


def _apportion(table: DataFrame, by: str) -> DataFrame:
    schema = StructType([*table.schema.fields, StructField("quota", LongType())])
    return table.groupBy(by).applyInPandas(_apportioned, schema)


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Per source: words, documents, place and target words.

    A target stops at ``epochs`` times the source's words; what it leaves is shared by weight among the
    others.  In the order of words per weight the stopped sources come first, so running sums find them.
    """
    sources = sized.groupBy("no_source", "source_name").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_docs")
    )
    # one small row per source, in one task
    ranked = sources.withColumn("place", F.row_number().over(Window.orderBy("no_source", "source_name")))
    cycle = F.array(*(F.lit(w) for w in weights))
    ranked = ranked.withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    ).withColumn("most_words", F.col("source_size") * epochs)
    everyone = Window.partitionBy()
    before = Window.orderBy(F.col("most_words") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    running = ranked.select(
        "*",
        (F.sum("source_size").over(everyone) - F.coalesce(F.sum("most_words").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("left_weight"),
    ).withColumn("stopped", F.col("most_words") * F.col("left_weight") <= F.col("left") * F.col("weight"))
    taken = F.sum(F.when(F.col("stopped"), F.col("most_words")).otherwise(0)).over(everyone)
    open_weight = F.sum(F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(everyone)
    share = F.try_divide(F.col("weight") * (F.sum("source_size").over(everyone) - taken), open_weight)
    target = F.when(F.col("stopped"), F.col("most_words").cast("double")).otherwise(share)
    return running.withColumn("target", target).drop("left", "left_weight", "stopped")


def _cut_to(wanted: int, times: np.ndarray, lengths: np.ndarray, turns: np.ndarray, epochs: int) -> np.ndarray:
    """Make the words taken as many as wanted: whole blocks more or fewer, and of one block its first words.

    Changes ``times`` and returns how many of each block's first words are taken once more, or, if below 0, once less.
    """
    part = np.zeros(len(times), np.int64)
    left = wanted - int((times * lengths).sum())
    step = 1 if left > 0 else -1
    # blocks taken least often gain first, those taken most often lose first, each kind in the order of the draw
    while left:
        open_blocks = times < epochs if step > 0 else times > 0
        edge = times[open_blocks].min() if step > 0 else times[open_blocks].max()
        for block in turns[(times == edge)[turns]]:
            if abs(left) < lengths[block]:
                part[block] = left
                return part
            times[block] += step
            left -= step * int(lengths[block])
            if not left:
                break
    return part


def _take(seed: int, block_words: int, epochs: int):
    """Words taken of each document of one shard."""

    def run(docs: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values(["order", "doc_id"], kind="stable").reset_index(drop=True)
        ends = np.cumsum(docs["size"].to_numpy(np.int64))
        words, quota = int(ends[-1]), int(docs["quota"].iloc[0])
        blocks = _block_count(words, block_words)
        edges = np.arange(blocks + 1, dtype=np.int64) * words // blocks
        each, more = divmod(quota, blocks)
        times = np.full(blocks, each, np.int64)
        place, shard = int(docs["place"].iloc[0]), int(docs["shard"].iloc[0])
        turns = np.random.default_rng([seed, place, shard]).permutation(blocks)
        times[turns[:more]] += 1
        part = np.zeros(blocks, np.int64)
        wanted = docs["wanted"].iloc[0]
        if not pd.isna(wanted):
            part = _cut_to(min(int(wanted), epochs * words), times, np.diff(edges), turns, epochs)
        # words taken before a point of the line rise by the block's count from edge to edge
        before = np.concatenate([[0], np.cumsum(times * np.diff(edges) + part)])
        block = np.minimum(np.searchsorted(edges, ends, "right") - 1, blocks - 1)
        inside = ends - edges[block]
        reached = before[block] + times[block] * inside + np.sign(part[block]) * np.minimum(inside, np.abs(part[block]))
        docs["taken"] = np.diff(reached, prepend=0)
        return docs

    return run


def _block_count(words: int, block_words: int) -> int:
    return max(1, (words + block_words // 2) // block_words)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    epochs: int = EPOCHS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``order``.

    ``order`` is the seeded hash of id and text that places a document in its shard.
    """
    sized = keep(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).isNull().alias("no_source"),
            filled(source_col).alias("source_name"),
            F.regexp_count(filled(text_col), F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("order"),
        ),
        "sizes",
    )
    targets = source_targets(sized, weights, epochs)
    shards = F.ceil(F.col("source_size") / shard_words).cast("bigint")
    sources = targets.select(
        "*",
        F.greatest(F.lit(1).cast("bigint"), shards).alias("shards"),
        F.col("target").alias("votes"),
        (F.col("source_size") * epochs).alias("most"),
        F.round(F.sum("source_size").over(Window.partitionBy()) / block_words).cast("bigint").alias("house"),
        F.lit(0).alias("all"),
    )
    facts = keep(_apportion(sources, "all").withColumnRenamed("quota", "source_quota"), "sources").select(
        "no_source", "source_name", "source_docs", "source_size", "target", "place", "shards", "source_quota"
    )
    placed = join_groups(
        sized, facts, ["no_source", "source_name"], "source_docs", F.xxhash64("order")
    ).withColumn("shard", F.pmod(F.col("order"), F.col("shards")))
    columns = ["doc_id", "size", "source_size", "target", "taken", "order"]
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    lines = placed.where("size > 0")
    blocks = F.greatest(F.lit(1).cast("bigint"), F.floor((F.col("votes") + block_words // 2) / block_words))
    shard_rows = lines.groupBy("place", "shard").agg(
        F.sum("size").cast("bigint").alias("votes"), F.first("source_quota").alias("house")
    )
    # a source's shards are told apart by their number, and take turns in that order
    votes = shard_rows.select(
        F.col("place").alias("source_place"), F.col("shard").alias("place"), "votes", "house",
        (blocks * epochs).alias("most"),
    )
    quotas = keep(_apportion(votes, "source_place"), "quotas").select(
        F.col("source_place").alias("place"), F.col("place").alias("shard"), "quota"
    )
    chosen = lines.join(quotas, ["place", "shard"]).select(
        "place", "shard", "doc_id", "order", "size", "quota", "source_size", "target",
        # a source of one shard is small enough for a block to count: its last block is cut
        F.when(F.col("shards") <= 1, F.round("target")).alias("wanted"),
    )
    id_type = sized.schema["doc_id"].dataType.simpleString()
    schema = (
        f"place int, shard bigint, doc_id {id_type}, `order` bigint, size bigint, quota bigint,"
        " source_size bigint, target double, wanted double, taken bigint"
    )
    taken = chosen.groupBy("place", "shard").applyInPandas(_take(seed, block_words, epochs), schema)
    return taken.select(*columns).unionByName(empty.select(*columns))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, **options
) -> DataFrame:
    """The documents the mix takes: all their columns in ``row``, and in ``mix`` their sizes and words taken.

    Rows that repeat id and text come back once, with the words taken of all of them.
    """
    mixed = mix(docs, id_col, text_col, seed=seed, **options).where("taken > 0").groupBy("order").agg(
        F.struct(
            F.max("size").alias("size"), F.max("source_size").alias("source_size"),
            F.max("target").alias("target"), F.sum("taken").alias("taken"),
        ).alias("mix")
    )
    order = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("order")
    rows = docs.select(F.struct("*").alias("row"), order).dropDuplicates(["order"])
    return rows.join(mixed, "order").select("row", "mix")
