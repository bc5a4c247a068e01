"""Blocks round trip, and what files say against the tokenizer itself."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import frame, messy

from lakemill.llm import token_files as tf
from lakemill.llm.warc import archive_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")

IDS = st.lists(st.one_of(st.integers(0, 300), st.integers(0, 50256), st.integers(0, 2**32 - 1)), max_size=700)


@settings(max_examples=200, deadline=None)
@given(IDS)
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    data, sizes = tf.encode_blocks(ids)
    assert len(data) == sizes.sum() and len(sizes) == -(-len(ids) // tf.BLOCK)
    assert (tf.decode_blocks(data, np.cumsum(sizes) - sizes) == ids).all()


def test_outliers_are_exceptions_and_do_not_widen_the_block():
    ids = np.full(128, 1000, np.uint32) + np.arange(128, dtype=np.uint32) % 8
    small = len(tf.encode_blocks(ids)[0])
    ids[[3, 77]] = [50_000, 4_000_000_000]
    assert len(tf.encode_blocks(ids)[0]) == small + 2 * 5
    assert small == 7 + 3 * 16  # three bits an id


class _Sink(io.BytesIO):
    def close(self):
        pass


def written(docs):
    sink = _Sink()
    writer = tf.Writer(sink)
    for doc, ids in docs:
        writer.add(doc, np.array(ids, np.uint32))
    assert writer.close() == len(sink.getvalue())
    return pa.BufferReader(sink.getvalue())


@pytest.mark.parametrize("chunk", [tf.BLOCK, 3 * tf.BLOCK, tf.CHUNK])
def test_file_round_trip_and_random_access(monkeypatch, chunk):
    monkeypatch.setattr(tf, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    docs = [(None, [5]), (None, [5]), (-3, [])] + [(i, rng.integers(0, 60000, rng.integers(0, 900))) for i in range(40)]
    stream = written(docs)
    whole = np.concatenate([np.array(ids, np.uint32) for _, ids in docs])
    at, expected = 0, []
    for doc, ids in docs:
        expected.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert list(tf.documents(stream)) == expected
    index = tf.Index(stream)
    for start, stop in [(0, 0), (0, 1), (127, 129), (1000, 5000), (0, len(whole)), (len(whole) - 1, len(whole))]:
        assert (tf.read_ids(stream, index, start, stop) == whole[start:stop]).all()


def test_a_file_cut_short_is_refused():
    with pytest.raises(ValueError):
        tf.Index(pa.BufferReader(written([(1, [1, 2, 3])]).read()[:-1]))


def test_no_documents_in_a_file():
    assert list(tf.documents(written([]))) == []


WORDS = [" ", "  ", "\n", "\t ", "the", " Über", " straße,", " end.\nThe", " so,\nÄnd!!", " don't\nwe", "The's", "it's", "don't", "1234", "é", "ß", "日本", "…", "<|endoftext|>", "!!", " ", "\x85", "\x1c", "a"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(WORDS), max_size=30).map("".join), st.text(max_size=60)), st.sampled_from([1, 5, 1 << 20]))
def test_pieces_give_the_ids_of_the_whole_text(text, window):
    encoder = _encoder()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tf, "WINDOW_CHARS", window)
        assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


_ENCODERS = []


def _encoder():
    if not _ENCODERS:
        _ENCODERS.append(tf.Encoder(PATH))
    return _ENCODERS[0]


def test_a_full_memory_of_pieces_is_forgotten(monkeypatch):
    monkeypatch.setattr(tf, "HELD_PIECES", 5)
    encoder = tf.Encoder(PATH)
    for i in range(20):
        text = f"one two three w{i} x{i} one"
        assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 12 and len(encoder.older) <= 12


def plain(rows):
    def order(row):
        return (row[0] is not None, row[0] or 0)

    out, at, encoder = [], 0, _encoder()
    for doc, text, *_ in sorted(rows, key=order):
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("limits", [{}, {"file_ids": 500, "task_bytes": 4000}])
def test_documents_against_the_tokenizer(spark, limits):
    rows = [(i, t, lang, s) for i, t, lang, s in messy()]
    rows += [(900, "a long text " * 20_000, "en", "s0"), (901, "x" * 5_000, "en", "s0"), (-7, "first of all", "en", "s0")]
    root = archive_folder(spark, "token-ids")
    manifest = tf.write(frame(spark, rows), root, PATH, **limits)
    got = [tuple(r) for r in tf.read(manifest, root).collect()]
    expected = plain(rows)
    # rows of equal id are in the order of a hash, so only what their order does not change is compared
    twice = {d for d in [r[0] for r in rows] if [r[0] for r in rows].count(d) > 1}
    assert sorted((r for r in got if r[0] not in twice)) == sorted(r for r in expected if r[0] not in twice)
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), r[2], r[3]) for r in expected)
    starts = sorted((r[1], r[2]) for r in got)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    if limits:
        assert manifest.count() > 5


def test_files_of_a_repeated_task_are_not_read(spark):
    rows = [(i, f"text {i}", "en", "s0") for i in range(50)]
    root = archive_folder(spark, "token-ids")
    first = tf.write(frame(spark, rows), f"{root}/run", PATH)
    once = sorted(tuple(r) for r in tf.read(first, f"{root}/run").collect())
    again = frame(spark, rows).selectExpr("0 AS part", "doc_id AS doc", "text")
    # a second attempt leaves files that are in no manifest
    again.mapInArrow(tf._writer(f"{root}/run", PATH, 0, 10), tf._MANIFEST).collect()
    assert sorted(tuple(r) for r in tf.read(first, f"{root}/run").collect()) == once


def test_no_documents(spark):
    root = archive_folder(spark, "token-ids")
    assert tf.read(tf.write(frame(spark, [], 1), root, PATH), root).collect() == []


def test_letters_and_marks_are_each_tokenized_once():
    encoder = tf.Encoder(PATH)
    plain, seen = encoder.tokenizer.model, []

    class Counted:
        def tokenize(self, run):
            seen.append(run)
            return plain.tokenize(run)

    encoder.model = Counted()
    text = "start word word, word. word; other, other. other\nword. été, été. word,\nother, end"
    expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(text).tolist() == expected
    assert len(seen) == len(set(seen)) > 0


def test_lines_do_not_join_their_words():
    encoder, words = tf.Encoder(PATH), ["alpha", "beta.", "Gamma", "été,", "1234", "don't", "-x"]
    lines = [f"{a}\n{b}" for a in words for b in words]
    text = " ".join(["start", *lines])
    assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    # a word behind a blank, its letters, a word behind a line feed
    assert len(encoder.known) <= 3 * len(words)


def test_a_worker_keeps_its_encoder(tmp_path):
    import os
    import shutil

    assert tf._held_encoder(PATH) is tf._held_encoder(PATH)
    other = str(shutil.copy(PATH, tmp_path / "other.json"))
    first = tf._held_encoder(other)
    os.utime(other, ns=(1, 1))
    assert tf._held_encoder(other) is not first and len(tf._HELD) == 1


BREAKS = ["\n", "\n\n", " \n", "\n ", "\r\n", "\t\n", " ", "  "]
PARTS = ["word", "Straße,", "a×", "a×,", "×", "1234,", "12", "don't,", "'s", "-", "“so”", "日本,", "ªº", "µ,", "end.", "", "\x00", "É!"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(PARTS), st.sampled_from(BREAKS)), max_size=25))
def test_pieces_between_lines_give_the_ids_of_the_whole_text(parts):
    text, encoder = "".join(a + b for a, b in parts), _encoder()
    assert encoder(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
