"""Records found by the parity of quotes, against the reader that takes whole files."""

import csv
import random

import pytest

from conftest import rows
from lakemill.schemas import text_schema
from lakemill.sources import read_csv, read_split_csv

COLUMNS = ("a", "b", "c")


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, each a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "300"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def write(path, data, lineterminator="\n", quoting=csv.QUOTE_MINIMAL):
    with path.open("w", newline="") as out:
        writer = csv.writer(out, lineterminator=lineterminator, quoting=quoting)
        writer.writerow(COLUMNS)
        writer.writerows(data)


def messy(seed, n):
    rng = random.Random(seed)
    parts = ["x", "Üß", '"', '""', "\n", "\n\n", ",", " ", "long " * 60, "", "日本", "'"]
    # a field of blanks alone is what readers differ in
    field = lambda: "v" + "".join(rng.choice(parts) for _ in range(rng.randrange(5))) + "w"
    return [(str(i), field(), rng.choice([field(), "plain"])) for i in range(n)]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, quoting):
    for i in range(3):
        write(tmp_path / f"part {i}.csv", messy(i, 120), quoting=quoting)
    schema = text_schema(COLUMNS)
    got = read_split_csv(spark, str(tmp_path), schema)
    assert got.schema == schema
    assert rows(got) == rows(read_csv(spark, str(tmp_path), schema, multiline=True)) == sorted(
        (r for i in range(3) for r in messy(i, 120)), key=lambda r: [(v is not None, v) for v in r]
    )


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    from lakemill.sources.split_csv import _lines

    # a field over many splits, and one that begins with a split's only start
    data = messy(5, 200) + [("big", "line\n" * 2000, "z"), ("next", "\n" * 500, "z"), ("last", "v", "w")]
    write(tmp_path / "one.csv", data)
    assert _lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows(read_split_csv(spark, f"{tmp_path}/one.csv", text_schema(COLUMNS))) == rows(
        spark.createDataFrame(data, text_schema(COLUMNS))
    )


def test_types_line_ends_and_missing_last_break(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_bytes(b'\xef\xbb\xbfa,b,c\r\n1,"two\r\nlines",2024-01-02\r\n\r\nx,,\r\n3,"q ""q""",bad')
    got = read_split_csv(spark, str(tmp_path), spark.sql("SELECT 1 AS a, '' AS b, current_date() AS c").limit(0).schema)
    assert rows(got.selectExpr("a", "b", "cast(c AS string) AS c")) == rows(spark.createDataFrame(
        [(1, "two\r\nlines", "2024-01-02"), (None, None, None), (3, 'q "q"', None)], "a int, b string, c string"
    ))


def test_another_header_fails(spark, tmp_path):
    write(tmp_path / "x.csv", [("1", "2", "3")])
    with pytest.raises(Exception, match="another header"):
        read_split_csv(spark, str(tmp_path), text_schema(("a", "c", "b"))).collect()


def test_no_rows(spark, tmp_path):
    write(tmp_path / "x.csv", [])
    assert read_split_csv(spark, str(tmp_path), text_schema(COLUMNS)).collect() == []
