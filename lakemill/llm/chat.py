r"""Prefix-target expansion: one training example per assistant turn.

A conversation is formatted once, as a line of segments, one per turn in the order of ``turn``:

    [INST]role[/INST]text</s>

Inside role and text a backslash becomes two, and every control string (``<s>``, ``</s>``, ``[INST]``,
``[/INST]``) gets a backslash after its first character, so none is left in an escaped text.
Dropping each backslash and keeping the character behind it reads both back.

Every assistant turn is an example: ``<s>``, all segments before it as context, then its own segment, of which
only the escaped reply is trainable.  :func:`expand` gives each with the whole text of its context, so a conversation
of n turns makes text of the order of n^2.  It is made row by row from the conversation, which meets in one task,
and only digests of it are shuffled by the query.  Where examples are to be stored without their contexts,
:func:`render` adds those later.

Defined cases: null roles and texts are empty; a null turn number comes first; rows of equal
turn number are ordered by role, then text, and repeated rows are turns of their own; a null ``conv_id`` is a
conversation like others.  A conversation without assistant turns has segments and no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import filled

BEGIN, END, ROLE, TEXT = "<s>", "</s>", "[INST]", "[/INST]"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"(<|\[)(/?s>|/?INST\])", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn: ``conv_id``, ``pos``, ``segment``, its ``start`` in the conversation, ``loss_start``, ``loss_chars``.

    Positions count code points; ``loss_chars`` is null for turns that are not trained.
    """
    raw = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        filled(role_col).alias("role"),
        filled(text_col).alias("text"),
    )
    # escaped above the window: the shuffle below it carries each text once
    role_part = F.concat(F.lit(ROLE), escape(F.col("role")), F.lit(TEXT))
    reply = escape(F.col("text"))
    segment = F.concat(role_part, reply, F.lit(END))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    trained = F.col("role") == TRAINED
    return raw.select(
        "conv_id",
        F.row_number().over(order).alias("pos"),
        segment.alias("segment"),
        (len(BEGIN) + F.coalesce(F.sum(F.length(segment).cast("bigint")).over(before), F.lit(0))).alias("start"),
        F.when(trained, F.length(role_part)).alias("loss_offset"),
        F.when(trained, F.length(reply)).alias("loss_chars"),
    )


def _context(turns: Column, pos: Column) -> Column:
    """Text of a conversation, given as its turns in order, up to the turn of a position."""
    earlier = F.slice(turns["segment"], F.lit(1), pos - 1)
    return F.concat(F.lit(BEGIN), F.array_join(earlier, ""))


def expand(turns: DataFrame) -> DataFrame:
    """One example per assistant turn: ``context``, the text of all turns before it, and its own segment as ``target``."""
    said = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "segment", "loss_offset", "loss_chars"))).alias("turns")
    )
    own = F.explode(F.filter("turns", lambda t: t["loss_chars"].isNotNull())).alias("own")
    examples = said.select("conv_id", "turns", own).select(
        "conv_id", "own", _context(F.col("turns"), F.col("own.pos")).alias("context")
    )
    length = F.length("context").cast("bigint")
    return examples.select(
        "conv_id",
        F.col("own.pos").alias("target_pos"),
        length.alias("context_chars"),
        (length + F.col("own.loss_offset")).alias("loss_start"),
        F.col("own.loss_chars").alias("loss_chars"),
        F.col("own.segment").alias("target"),
        "context",
    )


def render(examples: DataFrame, turns: DataFrame) -> DataFrame:
    """Chosen examples, whether or not they hold their contexts, with each context read from the turns anew."""
    examples = examples.drop("context")
    earlier = turns.select(F.col("conv_id").alias("_conv"), "pos", "segment")
    own = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("pos") < F.col("target_pos"))
    joined = examples.join(earlier, own, "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "segment"))))
    context = F.concat(F.lit(BEGIN), F.array_join(F.transform(parts, lambda p: p["segment"]), ""))
    return joined.groupBy(*examples.columns).agg(context.alias("context")).select(
        "conv_id", "target_pos", "context", "target", "loss_start", "loss_chars"
    )


def read_turns(turns: DataFrame) -> DataFrame:
    """Roles and texts from formatted segments alone: ``conv_id``, ``pos``, ``role``, ``text``, ``reply``.

    ``reply`` is what lies under the loss mask, null for turns that are not trained.
    """
    inside = F.substring(F.col("segment"), F.lit(len(ROLE) + 1), F.length("segment") - len(ROLE) - len(END))
    split = F.instr("inside", F.lit(TEXT))
    masked = F.substring(F.col("segment"), F.col("loss_offset") + 1, F.col("loss_chars"))
    parted = turns.withColumn("inside", inside).withColumn("split", split)
    return parted.select(
        "conv_id",
        "pos",
        "segment",
        unescape(F.substring(F.col("inside"), F.lit(1), F.col("split") - 1)).alias("role"),
        unescape(F.substring(F.col("inside"), F.col("split") + len(TEXT), F.length("inside"))).alias("text"),
        F.when(F.col("loss_chars").isNotNull(), unescape(masked)).alias("reply"),
    )


def _read_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation what :func:`read_turns` reads back, in order."""
    return read_turns(turns).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", "text", "reply", "segment"))).alias("turns"),
        (len(BEGIN) + F.sum(F.length("segment"))).cast("bigint").alias("formatted_chars"),
    )


def _said() -> Column:
    """Digest of all roles and texts of a conversation."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256")


def digest(turns: DataFrame) -> DataFrame:
    """Per conversation the number of turns and digests of what :func:`read_turns` reads back."""
    replies = F.array_join(F.transform("turns", lambda t: F.coalesce(t["reply"], F.lit(""))), "")
    return _read_conversations(turns).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        _said(),
        F.length(replies).cast("bigint").alias("loss_chars"),
        F.sha2(replies, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def digest_examples(turns: DataFrame) -> DataFrame:
    """As :func:`digest`, but what is trained is read from the text of the examples of :func:`expand`.

    Fails where an example's context is not the text of all turns before it, or a reply is not the target of exactly one.
    """
    reply = F.substring(F.concat("context", "target"), (F.col("loss_start") + 1).cast("int"), F.col("loss_chars"))
    made = expand(turns).select(
        F.col("conv_id").alias("_conv"),
        F.struct(
            F.col("target_pos").alias("pos"),
            F.col("context_chars").alias("chars"),
            F.unhex(F.md5("context")).alias("context"),
            F.unhex(F.md5("target")).alias("target"),
        ).alias("example"),
        unescape(reply).alias("reply"),
    )
    read = made.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("examples"))
    trained = F.array_join("examples.reply", "")
    read = read.select(
        "_conv",
        F.col("examples.example").alias("made"),
        F.length(trained).cast("bigint").alias("_loss_chars"),
        F.sha2(trained, 256).alias("_loss_sha256"),
    )

    def example(turn: Column) -> Column:
        context = _context(F.col("turns"), turn["pos"])
        return F.struct(
            turn["pos"].alias("pos"),
            F.length(context).cast("bigint").alias("chars"),
            F.unhex(F.md5(context)).alias("context"),
            F.unhex(F.md5(turn["segment"])).alias("target"),
        )

    wanted = F.transform(F.filter("turns", lambda t: t["role"] == TRAINED), example)
    said = _read_conversations(turns).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), _said(), "formatted_chars", wanted.alias("wanted")
    )
    joined = said.join(read, F.col("conv_id").eqNullSafe(F.col("_conv")), "full_outer")
    # an example of no conversation has no wanted ones beside it
    right = F.when(F.col("made").isNull(), F.size("wanted") == 0).otherwise(F.col("wanted") == F.col("made"))
    named = F.coalesce(F.col("conv_id").cast("string"), F.col("_conv").cast("string"), F.lit("null"))
    fault = F.raise_error(F.concat(F.lit("the examples do not match the turns of "), named))
    return joined.select(
        "conv_id",
        F.when(F.coalesce(right, F.lit(False)), F.col("n_turns")).otherwise(fault.cast("bigint")).alias("n_turns"),
        "turns_sha256",
        F.coalesce("_loss_chars", F.lit(0).cast("bigint")).alias("loss_chars"),
        F.coalesce("_loss_sha256", F.sha2(F.lit(""), 256)).alias("loss_sha256"),
        "formatted_chars",
    )
