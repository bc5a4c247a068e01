"""Exact duplicates: 128-bit content hash, smallest stable id, bytes compared inside groups.

Grouping is by (hash, normalised text): rows meet by the hash and are told apart by their bytes, so a
collision of the hash gives two groups.  Map tasks reduce a group to one row each before the shuffle,
however many copies it has.  Facts go back to the rows by (hash, SHA-256 of the normalised text).

Defined cases: a null text is empty, and empty texts equal one another.  Of equal texts the one with
the most code points stays, then the smallest id; a null id comes last.  Rows that repeat the id, text
and length of the row that stays are the same document and are marked alike; :func:`deduplicate`
returns one of them.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import BLANKS, filled, join_groups, keep


def _normalised(text: str) -> Column:
    return F.translate(filled(text), BLANKS, "")


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Per row its id, length, hash, whole normalised text and the row itself."""
    body = docs.select(
        F.col(id_col).alias("id"),
        F.length(filled(text_col)).alias("points"),
        _normalised(text_col).alias("body"),
        F.struct("*").alias("row"),
    )
    return body.withColumn("hash", digest(F.col("body")))


def _groups(rows: DataFrame) -> DataFrame:
    """Facts of the groups of two rows or more."""
    # the id itself is not negated: the smallest one has no counterpart
    stays = F.min(F.struct((-F.col("points")).alias("minus_points"), F.col("id").isNull(), F.col("id"))).alias("stays")
    groups = rows.groupBy("hash", "body").agg(F.count("*").alias("group_size"), stays)
    return groups.where("group_size > 1").select(
        "hash",
        F.sha2("body", 256).alias("sha"),
        "group_size",
        F.col("stays.id").alias("keep_id"),
        (-F.col("stays.minus_points")).alias("keep_points"),
    )


def mark_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: ``row`` (all its columns), ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Ids are integers.  ``digest`` is the content hash that groups rows before their bytes are compared.
    """
    rows = _rows(docs, id_col, text_col, digest)
    groups = keep(_groups(rows.drop("row")), "copies")
    hashed = rows.select("id", "points", "row", "hash", F.sha2("body", 256).alias("sha"))
    joined = join_groups(hashed, groups, ["hash", "sha"], "group_size", F.xxhash64("id", "points"))
    alone = F.col("group_size").isNull()
    first = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return joined.select(
        "row",
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | first).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, one per distinct text, with all their columns."""
    kept = mark_duplicates(docs, id_col, text_col).where("kept")
    single = kept.where("group_size = 1").select("row")
    # a group keeps one id; rows that repeat it meet here, a few per group
    repeated = kept.where("group_size > 1").groupBy("text_sha256").agg(F.min("row").alias("row"))
    return single.unionByName(repeated.select("row")).select("row.*")
