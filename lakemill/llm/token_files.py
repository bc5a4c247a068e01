r"""Token ids in files of patched frame-of-reference blocks.

A block holds 128 ids: their minimum, the rest above it packed at the width that nine in ten of them fit in, and an exception list
(position, higher bits) for the others.  A file ends in an index of where blocks start and of which ids belong to
which document, so any range of ids is read from its own blocks alone (:func:`read_ids`).

    blocks   minimum u32, width u8, count u8, exceptions u8 | packed bits | positions u8 | higher bits u32
    footer   block starts u64 | document ids i64 | null flags u8 | ends of documents, in ids, u64
    trailer  footer's place, blocks, documents, ids: u64 each | magic

All numbers are little-endian; ids may take 32 bits.

Documents are written in ascending order of id.  They are dealt to tasks by range, in as many ranges as their bytes ask
for, encoded and written there at once, so texts are shuffled once and ids never.  A task names its files
uniquely and reports them; only the manifest, which rows of succeeded tasks reach, says which files count, so
a lost or repeated task leaves files that nobody reads.  First ids of files are running sums over the manifest.

Texts are encoded by a byte-level tokenizer in pieces that end before a blank or a line feed between two visible characters, where
its own splitting always ends a piece as well, so equal pieces are encoded once and a long text never as one string.

Defined cases: a null text is an empty one and has the end id only; a null document id comes first; rows of equal id are
in the order of a hash of their text, repeated rows beside each other; names of special tokens inside a
text are ordinary text; no documents give no files.
"""

from __future__ import annotations

import gc
import os
import posixpath
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import filled, keep, running

BLOCK = 128
#: Share of a block's ids that its width has room for.
FITTING = 0.9
#: Ids encoded or decoded at a time.
CHUNK = 2048 * BLOCK
#: Ids after which a file ends, with the document at hand.
FILE_IDS = 1 << 24
#: Text that one task encodes.
TASK_BYTES = 64 << 20
#: Pieces of a generation that a Python worker remembers, and the longest of them.
HELD_PIECES, HELD_CHARS = 400_000, 32
#: Marks and beginnings of lines that a Python worker remembers.
HELD_RUNS = 100_000
#: Characters of a text that are encoded at a time.
WINDOW_CHARS = 1 << 20
MAGIC = b"PFORIDS1"

_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("count", "u1"), ("exceptions", "u1")])
_POWERS = np.uint64(1) << np.arange(32, dtype=np.uint64)
_TRAILER = struct.Struct("<QQQQ8s")
_VISIBLE = "[!-~\u00c0-\u024f]"
#: Letters whose spelling is known, and marks that may stand behind them: runs that are never split otherwise.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CUT = re.compile(f"(?<={_VISIBLE})(?= {_VISIBLE})")


def _spelling() -> dict[int, str]:
    """How a byte-level tokenizer spells line feeds, marks and the characters of :data:`_LETTERS`: visible bytes as themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    byte = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return {c: "".join(byte[b] for b in chr(c).encode()) for c in [0x0A, *range(0x20, 0x7F), *range(0xC0, 0x250)]}


_SPELLED = _spelling()


def _visible(char: str) -> bool:
    return "!" <= char <= "~" or "\u00c0" <= char <= "\u024f"


def _bounded(piece: str) -> bool:
    """Whether a piece begins, but for a line feed, and ends in visible characters, so that it is cut from its neighbours."""
    return _visible(piece[-1:]) and _visible(piece[1:2] if piece[:1] == "\n" else piece[:1])


def _windows(text: str) -> Iterator[str]:
    """A long text in parts that end where pieces end."""
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + WINDOW_CHARS)
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop


def _pieces(text: str) -> list[str]:
    """What stands between the blanks where a text may be cut; the others are inside pieces."""
    return [p if i == 0 else p[1:] for i, p in enumerate(_CUT.split(text))]


class Encoder:
    """Ids of whole texts.

    A piece is known by what follows its blank, or by its line feed and what follows that.  Pieces seen of late are looked up: two generations of at most
    ``HELD_PIECES``, of which the older is forgotten when the younger is full.
    """

    def __init__(self, path: str):
        # Spark runs a task per core; threads of the library's own would be in their way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        """Ids of marks, a line feed or letters behind it."""
        ids = self.runs.get(run)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(run.translate(_SPELLED))]).tobytes()
            if len(run) <= HELD_CHARS:
                if len(self.runs) >= HELD_RUNS:
                    self.runs.clear()
                self.runs[run] = ids
        return ids

    def _encode(self, texts: list[str]) -> dict[str, bytes]:
        done: dict[str, bytes] = {}
        for at in range(0, len(texts), 10_000):
            part = texts[at : at + 10_000]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            done.update((t, array("I", f.ids).tobytes()) for t, f in zip(part, found, strict=True))
        return done

    def _look_up(self, pieces: list[str], found: list[bytes | None], later: bool) -> list[int]:
        """Fill in what is older, or letters and marks, run by run as the tokenizer's own splitting has them; the places that are left."""
        others = []
        known, older, run = self.known, self.older, self._run
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            if not (i or later):
                others.append(i)
                continue
            ids = older.get(piece)
            if ids is None:
                line = piece[:1] == "\n"
                letters = (piece[1:] if line else piece).rstrip(_MARKS)
                if not letters.isalpha():
                    others.append(i)
                    continue
                marks = piece[len(letters) + line :]
                if not line:
                    # letters behind a blank are a piece of their own elsewhere
                    ids = known.get(letters) or older.get(letters)
                if ids is None:
                    if not (letters.isascii() or _LETTERS.fullmatch(letters)):
                        others.append(i)
                        continue
                    if line:
                        ids = run("\n") + run(letters)
                    else:
                        ids = array("I", [t.id for t in self.model.tokenize(f" {letters}".translate(_SPELLED))]).tobytes()
                if marks:
                    if not line and len(letters) <= HELD_CHARS:
                        known[letters] = ids
                    ids += run(marks)
            found[i] = ids
            if len(piece) <= HELD_CHARS:
                known[piece] = ids
        return others

    def _window(self, text: str, later: bool) -> bytes:
        """Ids of a window; a later one begins with the blank of its first piece."""
        text = text[later:]
        # a piece that begins with a line feed has no blank before it; blanks before one are left to the other cuts
        certain = " \n" not in text
        if certain:
            single = text[:1] != "\n" and text[-1:] != "\n" and not ("\n\n" in text or "\n " in text or "\r" in text)
            pieces = (text.replace("\n", " \n") if single else text).split(" ")
            found = list(map(self.known.get, pieces))
            if not later:
                found[0] = None  # has no blank before it
            others = self._look_up(pieces, found, later)
            # known pieces and words are bounded, so a cut can only be wrong beside others
            certain = all(_bounded(pieces[i]) for i in others)
        if not certain:
            pieces = _pieces(text)
            found = list(map(self.known.get, pieces))
            if not later:
                found[0] = None
            others = self._look_up(pieces, found, later)
        if others:
            keys = {i: f" {pieces[i]}" if (i or later) and pieces[i][:1] != "\n" else pieces[i] for i in others}
            learnt = self._encode(list(set(keys.values())))
            for i, key in keys.items():
                found[i] = learnt[key]
                if (i or later) and len(pieces[i]) <= HELD_CHARS and _bounded(pieces[i]):
                    self.known[pieces[i]] = found[i]
        if len(self.known) > HELD_PIECES:
            self.known, self.older = {}, self.known
        return b"".join(found)

    def __call__(self, text: str) -> np.ndarray:
        # a text makes many small objects and no cycles
        gc.disable()
        try:
            parts = [self._window(window, i > 0) for i, window in enumerate(_windows(text))]
        finally:
            gc.enable()
        return np.frombuffer(b"".join(parts), np.uint32)


_HELD: dict[tuple[str, int], Encoder] = {}


def _held_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which Spark gives one task after another; only the last one asked for is held."""
    key = (path, os.stat(path).st_mtime_ns)
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Encoder(path)
    return _HELD[key]


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(_POWERS, values, side="right")


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The lower bits of rows of values, packed."""
    octets = values.astype("<u4").view(np.uint8).reshape(len(values), BLOCK, 4)
    bits = np.unpackbits(octets, axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _unpacked(octets: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(octets), BLOCK, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(octets, axis=1, bitorder="little").reshape(len(octets), BLOCK, width)
    return np.packbits(bits.reshape(len(octets), -1), axis=1, bitorder="little").view("<u4")


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of some ids, and the bytes of each; the last one may hold fewer ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.int64)
    rows = np.full(blocks * BLOCK, ids[-1], np.uint32)
    rows[:n] = ids
    rows = rows.reshape(blocks, BLOCK)
    head = np.zeros(blocks, _HEAD)
    head["least"] = rows.min(axis=1)
    head["count"] = BLOCK
    head["count"][-1] = n - (blocks - 1) * BLOCK
    rest = rows - head["least"][:, None]
    nth = int(np.ceil(FITTING * BLOCK)) - 1
    width = _bit_length(np.partition(rest, nth, axis=1)[:, nth])
    head["width"] = width
    higher = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    block_of, position = np.nonzero(higher)
    head["exceptions"] = np.bincount(block_of, minlength=blocks)
    sizes = _HEAD.itemsize + width * (BLOCK // 8) + 5 * head["exceptions"].astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(blocks, -1)
    for w in np.unique(width):
        if w:
            of = width == w
            at = starts[of, None] + _HEAD.itemsize + np.arange(w * (BLOCK // 8))
            out[at] = _packed(rest[of], int(w))
    if len(block_of):
        lists = starts + _HEAD.itemsize + width * (BLOCK // 8)
        count = head["exceptions"].astype(np.int64)
        nth_of = np.arange(len(block_of)) - (np.cumsum(count) - count)[block_of]
        out[lists[block_of] + nth_of] = position
        four = lists[block_of] + count[block_of] + 4 * nth_of
        out[four[:, None] + np.arange(4)] = higher[block_of, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), sizes


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of blocks that lie in a row; starts count from the first one."""
    octets = np.frombuffer(data, np.uint8)
    starts = np.asarray(starts, np.int64)
    head = octets[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).reshape(-1)
    width, count = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            of = width == w
            rest[of] = _unpacked(octets[starts[of, None] + _HEAD.itemsize + np.arange(w * (BLOCK // 8))], int(w))
    if count.any():
        block_of = np.repeat(np.arange(len(starts)), count)
        nth_of = np.arange(len(block_of)) - (np.cumsum(count) - count)[block_of]
        lists = (starts + _HEAD.itemsize + width * (BLOCK // 8))[block_of]
        four = lists + count[block_of] + 4 * nth_of
        higher = octets[four[:, None] + np.arange(4)].copy().view("<u4").reshape(-1).astype(np.uint64)
        rest[block_of, octets[lists + nth_of]] |= (higher << width[block_of].astype(np.uint64)).astype(np.uint32)
    ids = rest + head["least"][:, None]
    used = head["count"].astype(np.int64)
    return ids.reshape(-1)[: (len(starts) - 1) * BLOCK + used[-1]] if len(starts) else ids.reshape(-1)


class Writer:
    """One file; ids wait until they fill whole blocks."""

    def __init__(self, stream):
        self.stream, self.waiting, self.held = stream, [], 0
        self.sizes: list[np.ndarray] = []
        self.docs: list[int | None] = []
        self.ends: list[int] = []
        self.ids = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.ids += len(ids)
        self.ends.append(self.ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= CHUNK:
            self._flush(self.held - self.held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, n, CHUNK):
            data, sizes = encode_blocks(ids[at : min(n, at + CHUNK)])
            self.stream.write(data)
            self.sizes.append(sizes)
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> int:
        """Write index and trailer; the file's bytes."""
        self._flush(self.held)
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
        footer = b"".join([
            starts.tobytes(),
            np.array([d or 0 for d in self.docs], "<i8").tobytes(),
            np.array([d is None for d in self.docs], np.uint8).tobytes(),
            np.array(self.ends, "<u8").tobytes(),
        ])
        trailer = _TRAILER.pack(int(starts[-1]), len(sizes), len(self.docs), self.ids, MAGIC)
        self.stream.write(footer + trailer)
        self.stream.close()
        return int(starts[-1]) + len(footer) + len(trailer)


class Index:
    """Where the blocks and documents of a file are."""

    def __init__(self, stream):
        size = stream.size()
        place, self.blocks, docs, self.ids, magic = _TRAILER.unpack(
            stream.read_at(_TRAILER.size, size - _TRAILER.size)
        )
        if magic != MAGIC:
            raise ValueError("not a file of token ids, or not whole")
        footer = stream.read_at(size - _TRAILER.size - place, place)
        at = 8 * (self.blocks + 1)
        self.starts = np.frombuffer(footer, "<u8", self.blocks + 1).astype(np.int64)
        self.docs = np.frombuffer(footer, "<i8", docs, at)
        self.null = np.frombuffer(footer, np.uint8, docs, at + 8 * docs)
        self.ends = np.frombuffer(footer, "<u8", docs, at + 9 * docs).astype(np.int64)


def read_ids(stream, index: Index, start: int, stop: int) -> np.ndarray:
    """Ids from start to stop, read from the blocks that hold them."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    first, last = start // BLOCK, -(-stop // BLOCK)
    place = int(index.starts[first])
    data = stream.read_at(int(index.starts[last]) - place, place)
    ids = decode_blocks(data, index.starts[first:last] - place)
    return ids[start - first * BLOCK : stop - first * BLOCK]


def documents(stream) -> Iterator[tuple[int | None, int, int, int]]:
    """Id, first id, number of ids and their CRC-32 of every document of a file, read in chunks."""
    index = Index(stream)
    start, crc, doc = 0, 0, 0
    for at in range(0, max(index.ids, 1), CHUNK):
        stop = min(index.ids, at + CHUNK)
        ids = read_ids(stream, index, at, stop).astype("<u4")
        done = at
        while doc < len(index.ends) and index.ends[doc] <= stop:
            end = int(index.ends[doc])
            crc = zlib.crc32(ids[done - at : end - at].tobytes(), crc)
            yield None if index.null[doc] else int(index.docs[doc]), start, end - start, crc
            start, crc, done, doc = end, 0, end, doc + 1
        crc = zlib.crc32(ids[done - at :].tobytes(), crc)


def _writer(root: str, tokenizer: str, end_id: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        encoder, end = _held_encoder(tokenizer), np.array([end_id], np.uint32)
        out, name, part, number = None, None, None, 0

        def closed() -> pa.RecordBatch:
            row = {"part": part, "number": number, "name": name, "docs": len(out.docs), "ids": out.ids, "bytes": out.close()}
            return pa.RecordBatch.from_pylist([row], schema=_ARROW_MANIFEST)

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                for own, doc, text in zip(*(rows.column(c).to_pylist() for c in ("part", "doc", "text")), strict=True):
                    if out is None:
                        part, name = own, f"tokens-{own:06d}-{number:06d}-{uuid.uuid4().hex}.pfor"
                        out = Writer(store.open_output_stream(posixpath.join(base, name), compression=None))
                    out.add(doc, np.concatenate([encoder(text), end]))
                    if out.ids >= file_ids:
                        yield closed()
                        out, number = None, number + 1
        if out is not None:
            yield closed()

    return run


_MANIFEST = "part int, number int, name string, docs bigint, ids bigint, bytes bigint"
_ARROW_MANIFEST = pa.schema([
    ("part", pa.int32()), ("number", pa.int32()), ("name", pa.string()),
    ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64()),
])
_DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
_ARROW_DOCUMENTS = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])


def write(
    docs: DataFrame,
    root: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Write the ids of all texts, each followed by ``end_id``, below ``root``; the stored manifest, a row per file.

    ``tokenizer`` is a file of the tokenizers library that every executor has.
    """
    asked = docs.agg((F.sum(F.octet_length(filled(text_col))) + F.count("*")).alias("bytes")).first()["bytes"] or 0
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), filled(text_col).alias("text")).withColumns(
        {"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()}
    )
    order = ["doc", "_hash", "_row"]
    ranged = texts.repartitionByRange(max(1, -(-asked // task_bytes)), *order).sortWithinPartitions(*order)
    parts = ranged.select(F.spark_partition_id().alias("part"), "doc", "text")
    written = keep(parts.mapInArrow(_writer(root, tokenizer, end_id, file_ids), _MANIFEST), "token-files")
    corpus = written.withColumn("corpus", F.lit(0))
    summed = running(corpus, "corpus", ["part", "number"], {"stop": (F.sum, F.col("ids"), lambda a, b: a + b)}, "file-order")
    manifest = summed.select(*written.columns, (F.col("stop") - F.col("ids")).alias("first_id"))
    manifest.write.parquet(posixpath.join(root, "manifest"))
    return docs.sparkSession.read.parquet(posixpath.join(root, "manifest"))


def _reader(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, size, first in zip(*(batch.column(c).to_pylist() for c in ("name", "bytes", "first_id")), strict=True):
                with store.open_input_file(posixpath.join(base, name)) as stream:
                    if stream.size() != size:
                        raise OSError(f"{name} does not have {size} bytes")
                    found = documents(stream)
                    while rows := list(islice(found, 10_000)):
                        doc, start, n, crc = zip(*rows, strict=True)
                        columns = [doc, [first + s for s in start], n, crc]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW_DOCUMENTS)

    return run


def read(manifest: DataFrame, root: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    files = manifest.select("name", "bytes", "first_id")
    return files.repartition(max(1, min(files.count(), 10_000)), "name").mapInArrow(_reader(root), _DOCUMENTS)
