r"""Deterministic sharded WARC writer and reader.

Pages become records, each a gzip member of its own.  Records are put in range order of page id; files
are cut where the running sum of compressed sizes passes a limit.  Both are found from exact sums, not from
samples, so the same pages give the same files, byte by byte, however Spark splits the work.
Headers and digests are made anew.  A task writes its files under temporary names and reports them as
manifest rows; only rows of tasks that succeeded reach the manifest, and a second job moves just those files
to their final names.  Files of lost or repeated tasks keep their temporary names and are never read.

Equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the one of the largest page id is the
response, the others are revisit records that name it.

Defined cases: a null html is an empty payload; a null url leaves the target header out; characters that
cannot stand in a header are percent-encoded; a null page id comes first and is written without its header;
rows that repeat the id of a group's response are responses too; no pages give no files.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lakemill.llm import common
from lakemill.llm.common import filled, join_groups, keep, row_key
from lakemill.storage import shared_folder

MIN_REVISIT = 1000
FILE_BYTES = 32 << 20
#: What the place of a file's first record takes, in memory.
FIRST_BYTES = 200
#: Written into every record, so that reruns agree.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_COLUMNS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _urn(key: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=bytes(key))}>"


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record(row, revisit: bool) -> bytes:
    """One WARC record as a gzip member; a revisit record needs no html."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.length}\r\n\r\n".encode()
    block = http if revisit else http + bytes(row.html)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(row.key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if row.url is None else quote(row.url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Page-ID", row.page),
        ("WARC-Payload-Digest", _base32(row.digest)),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).hexdigest())),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", _urn(row.response_key) if revisit else None),
        ("WARC-Refers-To-Page-ID", row.response if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _packer(revisit: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(record=[_record(row, revisit) for row in batch.itertuples(index=False)])[
                [c for c in batch.columns if c != "html"] + ["record"]
            ]

    return run


def _packed(rows: DataFrame, revisit: bool) -> DataFrame:
    schema = StructType([*(f for f in rows.schema if f.name != "html"), StructField("record", BinaryType())])
    return rows.mapInPandas(_packer(revisit), schema)


def pack(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Stored compressed responses of all pages: ``page`` (id as text), ``url``, ``key``, ``digest``, ``length``,
    ``record``, and ``number``, unique."""
    html = filled(html_col).cast("binary")
    read = pages.select(
        # as text, since pandas has no nulls among integers
        F.col(id_col).cast("bigint").cast("string").alias("page"),
        F.col(url_col).alias("url"),
        row_key(id_col, url_col, html_col).alias("key"),
        F.sha1(html).alias("digest"),
        # tells payloads apart; different ones of one SHA-1 are known
        F.unhex(F.sha2(html, 256)).alias("sha256"),
        F.octet_length(html).cast("bigint").alias("length"),
        html.alias("html"),
    )
    return keep(_packed(read, False).withColumn("number", F.monotonically_increasing_id()), "records")


def revisits(records: DataFrame) -> DataFrame:
    """Stored revisit records (``record``) of the pages whose payload another page's response holds."""
    facts = records.where(F.col("length") >= MIN_REVISIT).groupBy("sha256").agg(
        F.count("*").alias("copies"),
        F.max(F.struct(F.col("page").cast("bigint").alias("page_id"), F.col("key"))).alias("held"),
    )
    facts = keep(facts.where("copies > 1"), "payloads")
    narrow = records.select("number", "page", "url", "key", "digest", "sha256", "length")
    joined = join_groups(narrow, facts, ["sha256"], "copies", F.xxhash64("number")).where(
        F.col("held").isNotNull() & ~F.col("page").cast("bigint").eqNullSafe(F.col("held.page_id"))
    )
    named = joined.select(
        "number", "page", "url", "key", "digest", "length",
        F.col("held.page_id").cast("string").alias("response"), F.col("held.key").alias("response_key"),
    )
    return keep(_packed(named, True).select("page", "key", "number", "record"), "revisits")


_ORDER = ["page_id", "key", "number"]


def place(records: DataFrame, again: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``file`` of each record, beside its place in the order, by running sums over the range order."""
    small = again.select("number", F.octet_length("record").alias("small"))
    sizes = records.select(
        F.col("page").cast("bigint").alias("page_id"), "key", "number", F.octet_length("record").alias("large")
    ).join(small, "number", "left")
    sizes = sizes.select(*_ORDER, F.coalesce("small", "large").cast("bigint").alias("bytes"))
    ranged = sizes.repartitionByRange(*_ORDER).withColumn("part", F.spark_partition_id())
    sorted_ranges = keep(ranged, "order")
    # a row per partition
    parts = sorted_ranges.groupBy("part").agg(F.sum("bytes").alias("part_bytes"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("base") + F.coalesce(F.sum("bytes").over(within), F.lit(0))
    return sorted_ranges.join(F.broadcast(bases), "part").select(
        *_ORDER, F.floor(offset / file_bytes).cast("bigint").alias("file")
    )


def _position(page: str | None, key: bytes, number: int) -> tuple:
    return (page is not None, int(page or 0), bytes(key), int(number))


def _with_file(rows: DataFrame, placed: DataFrame) -> tuple[DataFrame, int]:
    """Rows (``page``, ``key``, ``number``, ...) with their ``file``, and how many files there are.

    The first record of every file, a small row, is sent to the executors where all of them fit in the limit
    for broadcasts; beyond it the rows are joined with their places.
    """
    first = placed.groupBy("file").agg(F.min(F.struct(*_ORDER)).alias("first"))
    first = keep(first.select("file", F.col("first.page_id").cast("string").alias("page"), "first.key", "first.number"), "files")
    files = first.count()
    if files * FIRST_BYTES > common.BROADCAST_BYTES:
        return rows.join(placed.select("number", "file").hint("merge"), "number"), files
    found = sorted((_position(r["page"], r["key"], r["number"]), r["file"]) for r in first.collect())
    sent = rows.sparkSession.sparkContext.broadcast(([p for p, _ in found], [f for _, f in found]))

    @F.pandas_udf("bigint")
    def file_of(page: pd.Series, key: pd.Series, number: pd.Series) -> pd.Series:
        starts, numbers = sent.value
        own = map(_position, page, key, number)
        return pd.Series([numbers[bisect_right(starts, p) - 1] for p in own], dtype="int64")

    return rows.withColumn("file", file_of("page", "key", "number")), files


def _writer(root: str):
    """Write runs of records to temporary files, one manifest row each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        current, out, row, digest, last = None, None, None, None, None

        def closed() -> pd.DataFrame:
            out.close()
            return pd.DataFrame([row | {"sha256": digest.hexdigest()}])

        for batch in batches:
            for file, number, record in zip(batch["file"], batch["number"], batch["record"], strict=True):
                if number == last:  # the revisit record before it stands for this response
                    continue
                last = number
                if file != current:
                    if out is not None:
                        yield closed()
                    current, digest, name = file, hashlib.sha256(), f"pages-{file:08d}.warc.gz"
                    row = {"file": file, "name": name, "temporary": f".{name}.{uuid.uuid4().hex}", "records": 0, "bytes": 0}
                    out = store.open_output_stream(posixpath.join(base, row["temporary"]), compression=None)
                out.write(record)
                digest.update(record)
                row["records"] += 1
                row["bytes"] += len(record)
        if out is not None:
            yield closed()

    return run


def _mover(root: str):
    """Give written files their final names; a file that a lost task has moved already is left alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.itertuples(index=False):
                source, target = posixpath.join(base, row.temporary), posixpath.join(base, row.name)
                if store.get_file_info(source).type == arrow_fs.FileType.File:
                    store.move(source, target)
                if store.get_file_info(target).size != row.bytes:
                    raise OSError(f"{target} does not have {row.bytes} bytes")
            yield batch

    return run


_MANIFEST = "file bigint, name string, temporary string, records bigint, bytes bigint, sha256 string"


def write(pages: DataFrame, root: str, file_bytes: int = FILE_BYTES, **columns: str) -> DataFrame:
    """Write archives below ``root`` and return the manifest, a row per file, stored beside them."""
    records = pack(pages, **columns)
    again = revisits(records)
    kinds = [again.withColumn("kind", F.lit(0)), records.select(*again.columns).withColumn("kind", F.lit(1))]
    rows, files = _with_file(kinds[0].unionByName(kinds[1]), place(records, again, file_bytes))
    order = [F.col("file"), F.col("page").cast("bigint"), F.col("key"), F.col("number"), F.col("kind")]
    runs = rows.repartition(_tasks(files), "file").sortWithinPartitions(*order).select("file", "number", "record")
    written = keep(runs.mapInPandas(_writer(root), _MANIFEST), "written")
    moved = _spread(written).mapInPandas(_mover(root), _MANIFEST)
    moved.write.parquet(posixpath.join(root, "manifest"))
    return pages.sparkSession.read.parquet(posixpath.join(root, "manifest"))


def _tasks(files: int) -> int:
    """A task for every few files."""
    return max(1, min(files, 10_000))


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.repartition(_tasks(manifest.count()), "file")


def _members(stream) -> Iterator[bytes]:
    unpacker, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            parts.append(unpacker.decompress(chunk))
            chunk = b""
            if unpacker.eof:
                yield b"".join(parts)
                chunk, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []


def _parse(record: bytes) -> tuple:
    head, block = record.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(headers["Content-Length"])]
    if _base32(hashlib.sha1(block).hexdigest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    http, payload = block.split(b"\r\n\r\n", 1)
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload {headers['WARC-Record-ID']}")
    return headers.get("WARC-Page-ID"), length, digest, kind, headers.get("WARC-Refers-To-Page-ID")


def _reader(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(root)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name in batch["name"]:
                rows = []
                with store.open_input_stream(posixpath.join(base, name), compression=None) as stream:
                    for record in _members(stream):
                        rows.append(_parse(record))
                        if len(rows) == 5000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

    return run


def read(manifest: DataFrame, root: str) -> DataFrame:
    """One row per record of the files a manifest names; digests are checked on the way."""
    text = _COLUMNS.replace("page_id bigint", "page_id string").replace("refers_to bigint", "refers_to string")
    return _spread(manifest.select("file", "name")).mapInPandas(_reader(root), text).withColumns(
        {c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")}
    )


def archive_folder(spark: SparkSession, purpose: str = "warc") -> str:
    """A fresh folder for archives in the shared folder, as a URI."""
    folder = shared_folder(spark, purpose)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
