import json
import os

import pytest

from conftest import rows
from lakemill import sinks, streaming
from lakemill.sinks import ledger
from lakemill.sinks.ledger import add_once


def land(spark, path, low, high, mode="append"):
    spark.range(low, high).selectExpr("id", "concat('r', id) AS v").repartition(3).write.mode(mode).parquet(path)


def test_ingest_is_incremental(spark, schema, tmp_path):
    path, table, ledger = f"{tmp_path}/landing", f"{schema}.people", f"{tmp_path}/ledger"
    land(spark, path, 0, 10)
    files = spark.read.parquet(path).schema
    ingest = lambda: streaming.ingest_available(spark, path, files, table, ledger, max_files=2)
    ingest()
    assert spark.table(table).columns == ["id", "v", "ingest_ts"]
    assert spark.table(table).select("ingest_ts").distinct().count() == 2  # one stamp per micro-batch
    ingest()
    assert spark.table(table).count() == 10
    land(spark, path, 10, 15)
    ingest()
    assert rows(spark.table(table).drop("ingest_ts")) == rows(spark.read.parquet(path))


def test_bulk_load_takes_each_file_once(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.people"
    land(spark, path, 0, 10)
    sinks.empty_table_like(spark, table, path)
    for low, high in ((10, 15), (15, 15)):
        streaming.bulk_load(spark, path, table, f"{tmp_path}/ledger")
        land(spark, path, low, high)
    streaming.bulk_load(spark, path, table, f"{tmp_path}/ledger")
    assert rows(spark.table(table)) == rows(spark.read.parquet(path))


def test_continuous_run_picks_up_new_files(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.people"
    land(spark, path, 0, 5)
    files = streaming.arriving_files(spark, path, spark.read.parquet(path).schema)
    running = streaming.run_into(files, table, f"{tmp_path}/ledger", interval="0 seconds")
    try:
        running.processAllAvailable()
        land(spark, path, 5, 9)
        running.processAllAvailable()
    finally:
        running.stop()
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 9


def test_a_stream_shares_its_table_with_batch_rows(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.people"
    land(spark, path, 0, 5)
    spark.range(100, 103).selectExpr("id", "'batch' AS v").write.saveAsTable(table)
    for _ in range(2):
        streaming.bulk_load(spark, path, table, f"{tmp_path}/ledger")
    sinks.cluster_table(spark, table, ("v",))
    land(spark, path, 5, 9)
    for _ in range(2):
        streaming.bulk_load(spark, path, table, f"{tmp_path}/ledger")
    assert sorted(r.id for r in spark.table(table).collect()) == [*range(9), 100, 101, 102]


def test_a_target_with_the_sinks_own_log_goes_on_as_it_was(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.old"
    land(spark, path, 0, 5)
    files = streaming.arriving_files(spark, path, spark.read.parquet(path).schema)
    begun = files.writeStream.option("checkpointLocation", f"{tmp_path}/ledger").trigger(availableNow=True).toTable(table)
    begun.awaitTermination()
    land(spark, path, 5, 9)
    streaming.drain_into(files, table, f"{tmp_path}/ledger")
    assert sorted(r.id for r in spark.table(table).collect()) == list(range(9))
    with pytest.raises(ValueError, match="log of its own"):
        add_once(spark.table(table), table, "x")


def test_loads_take_each_file_once(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.people"
    land(spark, path, 0, 10)
    spark.range(100, 103).selectExpr("id", "'batch' AS v").write.saveAsTable(table)
    assert streaming.load_new_files(spark, path, table, max_files=2) == 3
    assert streaming.load_new_files(spark, path, table) == 0
    sinks.zorder_table(spark, table, ("id", "v"), partitions=2)
    assert streaming.load_new_files(spark, path, table) == 0
    land(spark, path, 10, 15)
    assert streaming.load_new_files(spark, path, table) == 3
    assert sorted(r.id for r in spark.table(table).collect()) == [*range(15), 100, 101, 102]
    # a file that has changed is the same file, unless it is asked for
    for part in sorted((tmp_path / "landing").glob("*.parquet"))[:1]:
        os.utime(part, (1_700_000_000, 1_700_000_000))
    assert streaming.load_new_files(spark, path, table) == 0
    assert streaming.load_new_files(spark, path, table, reload_changed=True) == 1
    # replacing the table takes the ledger with the rows
    sinks.replace_table(spark.range(1).selectExpr("id", "'new' AS v"), table)
    assert streaming.load_new_files(spark, path, table) == 6


@pytest.mark.parametrize("dies", ["staging", "entry", "first move", "all moves"])
def test_a_load_that_died_is_repaired(spark, schema, tmp_path, monkeypatch, dies):
    path, table = f"{tmp_path}/landing", f"{schema}.people"
    land(spark, path, 0, 12)
    sinks.empty_table_like(spark, table, path)
    moves = []
    move, drop = ledger.move_file, ledger.delete_path

    def moving(spark, source, target):
        into_ledger = "/_ledger/" in target
        if dies == "staging" and into_ledger or dies == "entry" and not into_ledger or dies == "first move" and moves:
            raise KeyboardInterrupt
        move(spark, source, target)
        moves.extend([] if into_ledger else [target])

    def dropping(spark, path):
        if dies == "all moves":
            raise KeyboardInterrupt
        drop(spark, path)

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "move_file", moving)
        patch.setattr(ledger, "delete_path", dropping)
        with pytest.raises(KeyboardInterrupt):
            streaming.load_new_files(spark, path, table)
    if dies == "first move":
        sinks.cluster_table(spark, table, ("id",))  # half of a batch is there: the rest still comes
    for _ in range(2):
        streaming.load_new_files(spark, path, table)
        assert sorted(r.id for r in spark.table(table).collect()) == list(range(12))
    assert not list(tmp_path.glob("tables/people/_staged/*"))


def test_a_repeated_batch_adds_nothing(spark, schema):
    table = f"{schema}.t"
    sinks.replace_table(spark.range(3), table)
    for batch, expected in (("s-0", 5), ("s-0", 5), ("s-1", 7), ("s-1", 7)):
        add_once(spark.range(2), table, batch)
        assert spark.table(table).count() == expected
    sinks.cluster_table(spark, table, ("id",))
    assert not add_once(spark.range(2), table, "s-1")
    assert spark.table(table).count() == 7


def test_added_rows_fit_the_table(spark, schema):
    table = f"{schema}.t"
    sinks.create_table(spark, table, spark.range(0).selectExpr("id", "'' AS v").schema)
    add_once(spark.range(2).selectExpr("cast(id AS int) AS id"), table, "a")
    assert rows(spark.table(table)) == [(0, None), (1, None)]
    with pytest.raises(ValueError, match="no columns extra"):
        add_once(spark.range(2).selectExpr("id", "1 AS extra"), table, "b")
    spark.range(2).selectExpr("id", "id AS p").write.partitionBy("p").saveAsTable(f"{schema}.parts")
    with pytest.raises(ValueError, match="partitioned"):
        add_once(spark.range(2), f"{schema}.parts", "a")


def test_files_of_changing_shapes_lose_nothing(spark, schema, tmp_path):
    path, table = f"{tmp_path}/landing", f"{schema}.t"
    shapes = [
        "SELECT 1 AS id, 1.5D AS x, 'a' AS s, date'2024-01-02' AS d",
        "SELECT 2L AS id, '2.5' AS x, 7 AS s, '2024-02-30' AS d",  # widened, fits, is text, does not fit
        "SELECT 'three' AS ID, 1e0F AS x, named_struct('k', 1) AS s, '2024-03-01' AS d",
        "SELECT 4 AS id, array(1, 2) AS x, true AS more",
        "SELECT 5 AS id, 'no' AS more",
    ]
    spark.sql(shapes[0]).write.parquet(f"{path}/0")
    assert streaming.ingest_shapes(spark, path, table) == 1
    for i, shape in enumerate(shapes[1:], 1):
        spark.sql(shape).write.parquet(f"{path}/{i}")
    assert streaming.ingest_shapes(spark, path, table, max_files=3) == 4
    assert streaming.ingest_shapes(spark, path, table) == 0
    assert spark.table(table).columns == ["id", "x", "s", "d", "_rescued", "ingest_ts", "more"]
    got = {}
    for r in spark.table(table).collect():
        rescued = json.loads(r["_rescued"] or "{}")
        if rescued:
            assert "/landing/" in rescued.pop("_file_path")
        key = r.id if r.id is not None else rescued["id"]
        got[key] = (r.x, r.s, str(r.d), r.more, rescued)
    assert got == {
        1: (1.5, "a", "2024-01-02", None, {}),
        2: (2.5, "7", "None", None, {"d": "2024-02-30"}),
        "three": (1.0, '{"k":1}', "2024-03-01", None, {"id": "three"}),
        4: (None, None, "None", True, {"x": "[1,2]"}),
        5: (None, None, "None", None, {"more": "no"}),
    }


@pytest.mark.parametrize(
    ("have", "want", "fits"),
    [
        ("'12'", "int", "12"), ("'007'", "int", None), ("300", "tinyint", None), ("3L", "int", "3"), ("1.5D", "bigint", None),
        ("'1.5'", "double", "1.5"), ("date'2024-01-01'", "int", None), ("cast('x' AS binary)", "string", "x"),
        ("map('a', 1)", "string", '{"a":1}'), ("1", "array<int>", None), ("cast(null AS string)", "int", None),
    ],
)
def test_fitting_is_exact(spark, have, want, fits):
    from pyspark.sql import functions as F
    from lakemill.streaming.shapes import fitted

    one = spark.sql(f"SELECT {have} AS v")
    wanted = spark.sql(f"SELECT cast(null AS {want}) AS v").schema["v"].dataType
    value, left = fitted(F.col("v"), one.schema["v"].dataType, wanted)
    row = one.select(value.cast("string").alias("value"), left.alias("left"), F.col("v").isNull().alias("null")).first()
    assert row.value == fits
    assert (row.left is None) == (fits is not None or row.null)
