import gzip
import hashlib
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from lakemill.llm import warc

SCHEMA = "page_id bigint, url string, html string, key string, record string, digest string, number string"
BIG = "<p>éà</p>" * 200
ROWS = [(i, f"http://h/{i}", f"<html>{i}{'x' * (i * 37 % 900)}</html>") for i in range(60)]
ROWS += [(100 + i, f"http://copy/{i}", BIG) for i in range(25)]
ROWS += [(200, "http://small/1", "small"), (201, "http://small/2", "small")]
ROWS += [(300, None, None), (301, "bad\r\nX: y\x00 ü\\", ""), (302, "http://crlf", "a\r\n\r\nb\r\n\r\n" * 90)]
ROWS += [(400, "http://rep", BIG + "r")] * 3 + [(399, "http://rep", BIG + "r")]
ROWS += [(None, "http://none", "null id"), (None, "http://none", BIG + "n"), (500, "http://long", "long " * 200_000)]


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, *["clash"] * 4) for r in rows], SCHEMA).repartition(partitions)


def expected(rows):
    largest, copies = {}, Counter((html or "") for _, _, html in rows)
    for page, _, html in rows:
        key = html or ""
        largest[key] = max(largest.get(key, -1), -1 if page is None else page)
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and copies[html or ""] > 1 and (-1 if page is None else page) != largest[html or ""]
        refers = largest[html or ""] if again else None
        out[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", refers] += 1
    return out


def written(spark, tmp_path, name, partitions, rows=ROWS):
    root = f"file://{tmp_path}/{name}"
    manifest = warc.write(frame(spark, rows, partitions), root, file_bytes=6_000)
    return manifest, root


def test_round_trip(spark, tmp_path):
    manifest, root = written(spark, tmp_path, "a", 3)
    assert Counter(tuple(r) for r in warc.read(manifest, root).collect()) == expected(ROWS)


def test_same_files_however_rows_are_split(spark, tmp_path):
    columns = ["file", "name", "records", "bytes", "sha256"]
    runs = [
        sorted(tuple(r) for r in written(spark, tmp_path, f"n{n}", n)[0].select(*columns).collect()) for n in (1, 4)
    ]
    assert runs[0] == runs[1] and len(runs[0]) > 3


def test_places_beyond_the_broadcast_limit(spark, tmp_path, monkeypatch):
    columns = ["file", "name", "records", "bytes", "sha256"]
    sent = sorted(tuple(r) for r in written(spark, tmp_path, "sent", 2)[0].select(*columns).collect())
    monkeypatch.setattr("lakemill.llm.common.BROADCAST_BYTES", -1)
    joined = sorted(tuple(r) for r in written(spark, tmp_path, "joined", 2)[0].select(*columns).collect())
    assert sent == joined


def test_files_are_gzip_and_match_the_manifest(spark, tmp_path):
    manifest, _ = written(spark, tmp_path, "c", 2)
    rows = manifest.collect()
    found = {p.name: p.read_bytes() for p in Path(tmp_path, "c").glob("*.warc.gz")}
    assert found.keys() == {r["name"] for r in rows}
    for r in rows:
        data = found[r["name"]]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == r["records"]
    assert sum(r["records"] for r in rows) == len(ROWS)
    first = b"".join(gzip.decompress(found[r["name"]]) for r in sorted(rows, key=lambda r: r["file"]))
    ids = [int(x.split(b"\r\n")[0]) for x in first.split(b"WARC-Page-ID: ")[1:]]
    assert ids == sorted(ids)


def test_a_file_of_a_lost_task_is_never_read(spark, tmp_path):
    manifest, root = written(spark, tmp_path, "d", 2)
    Path(tmp_path, "d", ".pages-00000000.warc.gz.lost").write_bytes(b"half a file")
    assert warc.read(manifest, root).count() == len(ROWS)
    # moving again, as a repeated task would, changes nothing
    from lakemill.llm.warc import _mover

    again = manifest.mapInPandas(_mover(root), manifest.schema).collect()
    assert len(again) == manifest.count()


def test_no_pages(spark, tmp_path):
    manifest, root = written(spark, tmp_path, "e", 1, rows=[])
    assert manifest.count() == 0 and warc.read(manifest, root).count() == 0


def test_different_payloads_of_one_sha1_are_both_responses(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.functions.sha1", lambda column: F.lit("0" * 40))
    rows = [(1, "u", "a" * 2000), (2, "u", "b" * 2000), (3, "u", "b" * 2000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert [r["page"] for r in warc.revisits(warc.pack(pages)).collect()] == ["2"]
