r"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of :data:`WIDTH` turns, one row each, with a column per position.  ``ROLLUP`` over
these columns aggregates the prefixes of every length at once, and ``grouping_id`` tells how long each is.  A
conversation longer than a block continues in further rows, which are keyed by the node that its earlier blocks lead to,
so one ROLLUP does all blocks.  A second ROLLUP over the nodes sums up subtrees; what lies below a block reaches it by
pointer doubling over the block keys, in rounds that grow with the logarithm of the longest conversation.

A node is named by 128 bits: the XOR of hashes of (position, turn) along its path, so a parent's name is the node's
without its last turn, and the key of a block is the XOR of all turns before it.  Texts are hashed (SHA-256, 128 bits
kept) where they are read and never shuffled.

Positions and block keys are running aggregates over a range order, so a conversation that holds a third of
all rows is spread over tasks as well.  The digest of a node's own conversations is fed in order, 4096 ids at a
time at most.

Defined cases: null roles and texts are empty; a null turn number comes first; rows of equal turn number are ordered
by the hash of role and text, and repeated rows are turns of their own; rows without a conversation id belong to
no conversation and are left out; a conversation without turns is a member of the root; no conversations give no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import filled, join_groups, keep, running

#: Turns of a block, columns of a ROLLUP.
WIDTH = 4
#: Conversation ids are gathered by their value without the last bits, so at most 2^12 meet.
SLOT_BITS = 12
#: Longest opening that :func:`share_openings` takes from another conversation, and how many share one.
OPENING, SHARING = 6, 100

def turn_rows(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Narrow turns: ``conv_id``, ``turn``, ``said`` (hash of role and text) and ``chars`` of the text."""
    role, text = filled(role_col), filled(text_col)
    said = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.substring(said, 1, 32)).alias("said"),
        F.length(text).cast("bigint").alias("chars"),
    )


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with ``pos``, from 1, in their conversation."""
    one = {"pos": (F.sum, F.lit(1), lambda a, b: a + b)}
    return running(turns, "conv_id", ["turn", "said"], one, "turns")


def share_openings(turns: DataFrame) -> DataFrame:
    """Conversations rebuilt with openings of others, as turns for :func:`prefix_trie`.

    Conversation c begins with the first h turns of the first conversation of its hundred, where h is the CRC-32 of
    its decimal id modulo 6, and goes on with its own turns after the first h.
    """
    placed = keep(in_order(turns), "placed")
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING
    every = placed.where("pos = 1").select("conv_id")
    first = F.col("conv_id") - F.col("conv_id") % SHARING
    given = placed.where((F.col("pos") < OPENING) & (F.col("conv_id") == first)).select(
        F.col("conv_id").alias("giver"), "pos", "said", "chars"
    )
    takers = every.select("conv_id", first.alias("giver"), taken.alias("taken")).where("taken > 0")
    opened = takers.join(given, "giver").where("pos <= taken").select("conv_id", F.col("pos").alias("turn"), "said", "chars")
    own = placed.where(F.col("pos") > taken).select("conv_id", F.col("pos").alias("turn"), "said", "chars")
    # a row without a hash keeps a conversation that has no turn left
    none = every.select("conv_id", *(F.lit(None).cast(t).alias(c) for c, t in own.dtypes[1:]))
    return opened.unionByName(own).unionByName(none)


def _cells(width: int) -> list[str]:
    return [f"t{i}" for i in range(1, width + 1)]


def _filled(width: int) -> Column:
    return reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in _cells(width)))


def _blocks(turns: DataFrame, width: int) -> DataFrame:
    """One row per conversation and block: ``key_hi``, ``key_lo``, the cells, and ``more`` where another block follows."""
    placed = in_order(turns.where(F.col("said").isNotNull()))
    block = F.expr(f"cast((pos - 1) div {width} AS bigint)")
    opens_next = ((F.col("pos") - 1) % width == 0) & (F.col("pos") > 1)
    cells = placed.select(
        "conv_id",
        # the first turn of a block also tells the block before it that there is more
        F.explode(F.when(opens_next, F.array(block, block - 1)).otherwise(F.array(block))).alias("block"),
        block.alias("home"),
        F.struct(
            "pos",
            F.xxhash64("pos", "said").alias("hi"),
            F.xxhash64(F.lit("low"), "said", "pos").alias("lo"),
            "chars",
        ).alias("cell"),
    )
    lone = turns.where(F.col("said").isNull()).select(
        "conv_id", F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("home"),
        F.lit(None).cast(cells.schema["cell"].dataType).alias("cell"),
    )
    own = F.when(F.col("home") == F.col("block"), F.col("cell"))
    grouped = cells.unionByName(lone).groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(own)).alias("cells"),
        F.max(F.col("home") > F.col("block")).alias("more"),
        *(F.coalesce(F.bit_xor(own[half]), F.lit(0)).alias(half) for half in ("hi", "lo")),
    )
    xor = {f"id_{h}": (F.bit_xor, F.col(h), lambda a, b: a.bitwiseXOR(b)) for h in ("hi", "lo")}
    keyed = running(grouped, "conv_id", ["block"], xor, "blocks")
    return keyed.select(
        "conv_id", "block", "more", "id_hi", "id_lo",
        *(F.col(f"id_{h}").bitwiseXOR(F.col(h)).alias(f"key_{h}") for h in ("hi", "lo")),
        # all cells of a position are of one type; null where the conversation has ended
        *(F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(_cells(width))),
    )


def _rolled_up(rows: DataFrame, width: int, aggregates: str) -> DataFrame:
    """ROLLUP over the cells within each block: rows of real prefixes with ``at``, their length in the block, names and last turn."""
    cells = _cells(width)
    rolled = rows.sparkSession.sql(
        f"SELECT block, key_hi, key_lo, {', '.join(cells)}, {width} - bit_count(grouping_id()) AS at, {aggregates}"
        f" FROM {{rows}} GROUP BY block, key_hi, key_lo, ROLLUP ({', '.join(cells)})",
        rows=rows,
    )
    # a group over the empty cells behind a conversation's end is no prefix; a whole block is its key's node
    real = rolled.where((F.col("at") == _filled(width)) & ((F.col("at") > 0) | (F.col("block") == 0)))
    last = F.coalesce(*reversed([F.col(c) for c in cells]))
    names = {}
    for half in ("hi", "lo"):
        own = reduce(lambda a, b: a.bitwiseXOR(b), (F.coalesce(F.col(c)[half], F.lit(0)) for c in cells), F.col(f"key_{half}"))
        names[f"id_{half}"] = own
        names[f"parent_{half}"] = own.bitwiseXOR(F.coalesce(last[half], F.lit(0)))
    return real.withColumns(names | {"last_chars": F.coalesce(last["chars"], F.lit(0))})


def _below(nodes: DataFrame, width: int) -> DataFrame:
    """Per node that ends a block and has children: what lies below it (``leaves``, ``saved``) and ``children``."""
    inside = nodes.where("block > 0").groupBy(F.col("key_hi").alias("hi"), F.col("key_lo").alias("lo")).agg(
        F.sum(F.col("leaf").cast("bigint")).alias("leaves"), F.sum("saved").alias("saved"),
        F.count_if(F.col("at") == 1).alias("children"),
    )
    # the block above; blocks of the first row have none, which the root's key stands for
    above = nodes.where(F.col("at") == width).select(
        F.col("id_hi").alias("hi"), F.col("id_lo").alias("lo"),
        *(F.when(F.col("block") > 0, F.col(f"key_{h}")).otherwise(F.lit(0)).alias(f"up_{h}") for h in ("hi", "lo")),
    )
    sums = keep(inside.join(above, ["hi", "lo"]), "below")
    has_above = (F.col("up_hi") != 0) | (F.col("up_lo") != 0)
    while not sums.where(has_above).isEmpty():
        # a block's sums reach as far as its pointer; both double
        given = sums.where(has_above).groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count("*").alias("size")
        )
        grown = keep(sums.join(given, ["hi", "lo"], "left").select(
            "hi", "lo", "children", "up_hi", "up_lo", F.coalesce("size", F.lit(0)).alias("size"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        ), "below")
        pointers = grown.select(
            F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), "size",
            F.col("up_hi").alias("next_hi"), F.col("up_lo").alias("next_lo"),
        )
        moved = join_groups(grown.drop("size"), pointers, ["up_hi", "up_lo"], "size", F.col("lo"))
        sums = keep(moved.select(
            "hi", "lo", "leaves", "saved", "children",
            *(F.coalesce(f"next_{h}", F.lit(0)).alias(f"up_{h}") for h in ("hi", "lo")),
        ), "below")
    return sums.select(F.col("hi").alias("id_hi"), F.col("lo").alias("id_lo"), "leaves", "saved", "children")


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the parts of each node, which come in order, joined by commas."""
    node, digest = None, None
    for batch in batches:
        done = []
        for hi, lo, part in zip(batch["id_hi"], batch["id_lo"], batch["part"], strict=True):
            if (hi, lo) == node:
                digest.update(b"," + part.encode())
                continue
            if node is not None:
                done.append((*node, digest.hexdigest()))
            node, digest = (hi, lo), hashlib.sha256(part.encode())
        yield pd.DataFrame(done, columns=["id_hi", "id_lo", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=["id_hi", "id_lo", "ends_sha256"])


def _ends(blocks: DataFrame) -> DataFrame:
    """Digest of the ids, in order, of the conversations that end at each node."""
    slots = blocks.where(~F.coalesce("more", F.lit(False))).groupBy(
        "id_hi", "id_lo", F.shiftright("conv_id", SLOT_BITS).alias("slot")
    ).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    parts = slots.select("id_hi", "id_lo", "slot", F.array_join(F.col("ids").cast("array<string>"), ",").alias("part"))
    placed = parts.repartition("id_hi", "id_lo").sortWithinPartitions("id_hi", "id_lo", "slot")
    return placed.mapInPandas(_digested, "id_hi bigint, id_lo bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv_id``, ``turn``, ``said``, ``chars``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.  A row whose ``said`` is null only states that its conversation exists.
    """
    blocks = keep(_blocks(turns, width), "blocks")
    # one beyond the block where the conversation goes on
    reached = blocks.withColumn("reach", _filled(width) + F.coalesce(F.col("more").cast("int"), F.lit(0)))
    found = _rolled_up(reached, width, "count(*) AS n_convs, min(conv_id) AS conv_id, max(reach) AS reach")
    nodes = keep(found.select(
        "block", "key_hi", "key_lo", *_cells(width), "at", "id_hi", "id_lo", "conv_id", "n_convs",
        (F.col("reach") == F.col("at")).alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("last_chars")).alias("saved"),
    ), "nodes")
    below = _below(nodes, width).select("id_hi", "id_lo", *(F.col(c).alias(f"below_{c}") for c in ("leaves", "saved", "children")))
    hung = nodes.join(below, ["id_hi", "id_lo"], "left").na.fill(0, [f"below_{c}" for c in ("leaves", "saved", "children")])
    # children of a prefix are the nodes one longer in its block, or those that hang below the block
    counted = ", ".join(f"count_if(at = {i}) AS children_{i}" for i in range(1, width + 1))
    summed = _rolled_up(
        hung.drop("id_hi", "id_lo"), width,
        "min(conv_id) AS conv_id, max(n_convs) AS n_convs, sum(cast(leaf AS bigint) + below_leaves) AS n_leaves,"
        f" sum(saved + below_saved) AS saved_tokens, sum(below_children) AS children_{width + 1}, {counted}",
    )
    children = F.get(F.array(*(f"children_{i}" for i in range(1, width + 2))), F.col("at"))
    trie = keep(summed.select(
        "id_hi", "id_lo", "parent_hi", "parent_lo", "conv_id", (F.col("block") * width + F.col("at")).alias("depth"),
        "n_convs", children.alias("n_children"), "n_leaves", "saved_tokens",
    ), "trie")
    parents = trie.where("n_children > 0").select(
        F.col("id_hi").alias("parent_hi"), F.col("id_lo").alias("parent_lo"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size"),
    )
    known = join_groups(trie, parents, ["parent_hi", "parent_lo"], "size", F.col("id_lo"))
    named = known.join(_ends(blocks), ["id_hi", "id_lo"], "left")
    return named.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
