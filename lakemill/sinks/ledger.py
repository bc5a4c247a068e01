"""Batches that reach a table exactly once, whatever else is written to it.

A batch is written to ``_staged`` inside the table's folder, entered in ``_ledger`` there by one rename, and then its
files are moved into the table under names that begin with the batch's.  Readers skip both folders.  What dies before the
entry leaves nothing but staged files that are written again; what dies after it is finished by the next one
who meets the entry, as each file is moved once.  Batch writes, streams, loads and clustering can
so share a table: the ledger stays with its location, and goes with the rows when the table is dropped or replaced.

Loads enter the files they took, which later listings are compared with.  Streams enter the number of their batch, so that a
repeated batch adds nothing; a stream's earlier entry is dropped with its next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.sinks.tables import table_location
from lakemill.storage import delete_path, list_names, move_file, path_exists

ENTRIES = "path string, length bigint, modificationTime timestamp"


def _ledger(location: str) -> str:
    return f"{location}/_ledger"


def _staged(location: str) -> str:
    return f"{location}/_staged"


def _check_target(spark: SparkSession, table: str, location: str) -> None:
    if path_exists(spark, f"{location}/_spark_metadata"):
        raise ValueError(f"{table} is the target of a stream with a log of its own, which would hide added rows")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned; batches are added to tables that are not")


def _aligned(rows: DataFrame, table: str) -> DataFrame:
    """The rows in the columns and types of the table; columns that it lacks are refused, those that rows lack are NULL."""
    wanted = rows.sparkSession.table(table).schema
    extra = set(rows.columns) - set(wanted.names)
    if extra:
        raise ValueError(f"{table} has no columns {', '.join(sorted(extra))}")
    return rows.select(*(
        (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted
    ))


def _publish(spark: SparkSession, location: str, batch: str) -> None:
    """Move the files of an entered batch that are still staged into the table."""
    stage = f"{_staged(location)}/{batch}"
    for name in list_names(spark, stage):
        if not name.startswith(("_", ".")):
            move_file(spark, f"{stage}/{name}", f"{location}/{batch}-{name}")
    delete_path(spark, stage)


def is_entered(spark: SparkSession, location: str, batch: str) -> bool:
    return path_exists(spark, f"{_ledger(location)}/{batch}")


def add_once(
    rows: DataFrame, table: str, batch: str, files: DataFrame | None = None, table_format: str = "parquet"
) -> bool:
    """Append the rows to a table as the batch of this name; False when it has been entered before.

    ``files`` (path, length, modificationTime) are entered with it.  Batch names must not begin with ``_`` or ``.``.
    """
    spark = rows.sparkSession
    location = table_location(spark, table)
    _check_target(spark, table, location)
    if is_entered(spark, location, batch):
        _publish(spark, location, batch)
        return False
    _aligned(rows, table).write.format(table_format).mode("overwrite").save(f"{_staged(location)}/{batch}")
    entered = spark.createDataFrame([], ENTRIES) if files is None else files
    draft = f"{_staged(location)}/_entry-{batch}"
    entered.write.mode("overwrite").parquet(draft)
    move_file(spark, draft, f"{_ledger(location)}/{batch}")
    _publish(spark, location, batch)
    spark.catalog.refreshTable(table)
    return True


def forget(spark: SparkSession, table: str, batch: str) -> None:
    """Drop the entry of a batch that cannot come again."""
    location = table_location(spark, table)
    _publish(spark, location, batch)
    delete_path(spark, f"{_ledger(location)}/{batch}")


def repair(spark: SparkSession, table: str, prefix: str) -> None:
    """Finish the entered batches whose names begin so, and drop what is staged of others."""
    location = table_location(spark, table)
    for name in list_names(spark, _staged(location)):
        batch = name.removeprefix("_entry-")
        if not batch.startswith(prefix):
            continue
        if name == batch and is_entered(spark, location, batch):
            _publish(spark, location, batch)
        else:
            delete_path(spark, f"{_staged(location)}/{name}")
    spark.catalog.refreshTable(table)


def entered_files(spark: SparkSession, table: str, prefix: str) -> DataFrame:
    """The files entered with batches whose names begin so."""
    ledger = _ledger(table_location(spark, table))
    if not any(name.startswith(prefix) for name in list_names(spark, ledger)):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(f"{ledger}/{prefix}*")
