from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemill.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string, segment string, start string"
NASTY = [
    "</s>[INST] ok [/INST]", "\\[INST]", "[\\INST]", "\\\\</s>", "<\\/s>", "[[INST]]", "<<s>>", "\\", "a\\", "", "é\n[/INST",
    "<s>", "[/INST]</s><s>[INST]", "日本 \\s", "$1 \\1",
]
ROWS = [(i, j, ("user", "assistant")[j % 2], t) for i, t in enumerate(NASTY) for j in range(4)]
ROWS += [
    (50, 0, "user", "no reply"), (51, 0, None, None), (51, None, "assistant", "before all"), (51, 1, "assistant", None),
    (52, 0, "assistant", "x " * 30000), (53, 1, "b", "tie"), (53, 1, "a", "tie"), (53, 1, "a", "tie"), (None, 0, "assistant", "n"),
    (54, 0, "[INST]assistant</s>", "strange role"),
]


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(partitions)


def conversations(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in found.items()}


def test_digests_read_back_from_the_format(spark):
    found = {r.conv_id: r for r in chat.digest(chat.format_turns(frame(spark, ROWS))).collect()}
    expected = conversations(ROWS)
    assert found.keys() == expected.keys()
    for conv, turns in expected.items():
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        replies = "".join(text for role, text in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(replies), sha256(replies.encode()).hexdigest())
        assert r.formatted_chars >= sum(len(role) + len(text) for role, text in turns)


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    turns = chat.format_turns(frame(spark, ROWS))
    segments, examples = {}, []
    for r in turns.orderBy("conv_id", "pos").collect():
        segments.setdefault(r.conv_id, []).append(r.segment)
    for r in chat.render(chat.expand(turns), turns).collect():
        whole = r.context + r.target
        assert r.context == "<s>" + "".join(segments[r.conv_id][: r.target_pos - 1])
        assert r.target == segments[r.conv_id][r.target_pos - 1]
        reply = whole[r.loss_start : r.loss_start + r.loss_chars]
        assert whole.endswith(reply + "</s>")
        examples.append((r.conv_id is None, r.conv_id or 0))
    expected = [(c is None, c or 0) for c, t in conversations(ROWS).items() for role, _ in t if role == "assistant"]
    assert sorted(examples) == sorted(expected)


def test_no_control_string_is_left_in_a_text(spark):
    texts = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for r in texts.select("t", chat.escape(texts.t).alias("e"), chat.unescape(chat.escape(texts.t)).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="<>/s[]INST\\ a", max_size=25), min_size=1, max_size=40))
def test_round_trip_of_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat.escape(df.t).alias("e"), chat.unescape(chat.escape(df.t)).alias("u")).collect()
    assert all(r.u == r.t and "</s>" not in r.e and "[INST]" not in r.e for r in rows)


def test_no_rows(spark):
    turns = chat.format_turns(spark.createDataFrame([], SCHEMA))
    assert chat.digest(turns).count() == 0 and chat.expand(turns).count() == 0


def test_digests_of_the_examples_equal_those_of_the_turns(spark):
    turns = chat.format_turns(frame(spark, ROWS))
    assert sorted(map(str, chat.digest_examples(turns).collect())) == sorted(map(str, chat.digest(turns).collect()))


@pytest.mark.parametrize("fault", ["lost", "twice", "context", "target"])
def test_query_fails_with_wrong_examples(spark, tmp_path, monkeypatch, fault):
    from lakemill.llm.queries import QUERIES

    right = chat.expand
    wrong = {
        "lost": lambda e: e.where("not (conv_id = 1 and target_pos = 4)"),
        "twice": lambda e: e.unionByName(e.where("conv_id = 1 and target_pos = 2")),
        "context": lambda e: e.withColumn("context_chars", F.col("context_chars") - F.when(F.col("conv_id") == 1, 1).otherwise(0)),
        "target": lambda e: e.withColumn("target", F.when(F.col("conv_id") == 1, F.lit("other")).otherwise(F.col("target"))),
    }[fault]
    frame(spark, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op4_chat_prefix_targets"](spark, str(tmp_path)).count() > 0
    monkeypatch.setattr(chat, "expand", lambda turns: wrong(right(turns)))
    with pytest.raises(Exception, match="do not match the turns of 1"):
        QUERIES["op4_chat_prefix_targets"](spark, str(tmp_path)).collect()


def test_examples_hold_the_text_of_all_turns_before(spark):
    turns = chat.format_turns(frame(spark, ROWS))
    segments = {}
    for r in turns.orderBy("conv_id", "pos").collect():
        segments.setdefault(r.conv_id, []).append(r.segment)
    examples = chat.expand(turns).collect()
    assert len(examples) == sum(role == "assistant" for t in conversations(ROWS).values() for role, _ in t)
    for r in examples:
        assert r.context == "<s>" + "".join(segments[r.conv_id][: r.target_pos - 1])
        assert r.context_chars == len(r.context)


@pytest.mark.parametrize("change", ["context || ' '", "'<s>'", "null"])
def test_query_reads_the_text_of_the_contexts(spark, tmp_path, monkeypatch, change):
    from lakemill.llm.queries import QUERIES

    right = chat.expand
    frame(spark, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    changed = F.expr(f"case when conv_id = 1 and target_pos = 4 then {change} else context end")
    monkeypatch.setattr(chat, "expand", lambda turns: right(turns).withColumn("context", changed))
    with pytest.raises(Exception, match="do not match the turns of 1"):
        QUERIES["op4_chat_prefix_targets"](spark, str(tmp_path)).collect()
