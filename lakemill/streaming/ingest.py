"""Incremental ingestion with Structured Streaming.

The checkpoint is the ledger of files already taken, and each micro-batch is entered in the
ledger of its table (:mod:`lakemill.sinks.ledger`), so a restart after a lost driver or executor
neither drops nor repeats rows.  The target may hold batch rows and may be clustered between runs.
All streams here are stateless.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakemill.sinks.ledger import add_once, entered_files, forget, repair
from lakemill.sinks.tables import create_table, table_location
from lakemill.sources.files import ingest_stamp
from lakemill.storage import escape_glob, path_exists


def arriving_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_format: str = "parquet",
    max_files: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Stream of files appearing under a path; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", recursive).load(path)


def arriving_documents(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """Stream of whole documents, ready for the flattener."""
    return spark.readStream.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True).withColumnRenamed(
        "value", "text"
    )


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def _add_batches(spark: SparkSession, table: str, checkpoint: str, table_format: str):
    """Micro-batches go into the table once each, by the ledger of the table."""

    def add(rows: DataFrame, number: int) -> None:
        name = f"stream-{_query_id(spark, checkpoint)}"
        add_once(rows, table, f"{name}-{number}", table_format=table_format)
        if number:
            # Spark repeats the last batch only
            forget(spark, table, f"{name}-{number - 1}")

    return add


def _into(stream: DataFrame, table: str, checkpoint: str, table_format: str, **trigger) -> StreamingQuery:
    spark = stream.sparkSession
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    if spark.catalog.tableExists(table):
        if path_exists(spark, f"{table_location(spark, table)}/_spark_metadata"):
            # begun with the file sink's own log, which its readers follow
            return writer.format(table_format).toTable(table)
    else:
        create_table(spark, table, stream.schema, table_format)
    return writer.foreachBatch(_add_batches(spark, table, checkpoint, table_format)).start()


def drain_into(stream: DataFrame, table: str, checkpoint: str, table_format: str = "parquet") -> None:
    """Take everything that is there, in as many micro-batches as needed, and stop."""
    spark = stream.sparkSession
    _into(stream, table, checkpoint, table_format, availableNow=True).awaitTermination()
    spark.catalog.refreshTable(table)


def run_into(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    interval: str = "1 minute",
    table_format: str = "parquet",
) -> StreamingQuery:
    """Keep running, one micro-batch per interval; the caller stops the query."""
    return _into(stream, table, checkpoint, table_format, processingTime=interval)


def ingest_available(
    spark: SparkSession,
    path: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    recursive: bool = False,
) -> None:
    """Append files not seen before to a table, stamped with ``ingest_ts``."""
    files = arriving_files(spark, path, schema, max_files=max_files, recursive=recursive)
    drain_into(ingest_stamp(files, "ingest_ts"), table, checkpoint)


def bulk_load(
    spark: SparkSession, path: str, table: str, checkpoint: str, max_files: int | None = None
) -> None:
    """Load Parquet files not loaded before into an existing table, columns unchanged."""
    schema = spark.table(table).schema
    drain_into(arriving_files(spark, path, schema, max_files=max_files), table, checkpoint)


def new_files(
    spark: SparkSession, path: str, table: str, max_files: int, reload_changed: bool = False
) -> DataFrame | None:
    """At most so many files under a path that no load has entered in the table's ledger; None when there are none."""
    same = ["path", "length", "modificationTime"] if reload_changed else ["path"]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).drop("content")
    new = listed
    if spark.catalog.tableExists(table):
        new = listed.join(entered_files(spark, table, "load-"), same, "left_anti").select(*listed.columns)
    files = new.orderBy("path").limit(max_files).collect()
    return spark.createDataFrame(files, listed.schema).coalesce(1) if files else None


def load_new_files(
    spark: SparkSession,
    path: str,
    table: str,
    file_format: str = "parquet",
    max_files: int = 10_000,
    reload_changed: bool = False,
    table_format: str = "parquet",
) -> int:
    """Add the files under a path that the table's ledger does not have to an existing table; how many there were.

    Needs no checkpoint: the ledger is the table's own, so batch rows, streams and clustering do no harm.  A file
    counts as loaded by its path, or with ``reload_changed`` by path, size and time of change.  At most ``max_files``
    are one batch, whose paths alone come to the driver.  What an earlier load left unfinished is finished first.  One load at
    a time may run on a table.
    """
    repair(spark, table, "load-")
    schema = spark.table(table).schema
    loaded = 0
    while (entries := new_files(spark, path, table, max_files, reload_changed)) is not None:
        paths = [escape_glob(f["path"]) for f in entries.collect()]
        rows = spark.read.schema(schema).format(file_format).load(paths)
        add_once(rows, table, f"load-{uuid.uuid4().hex}", entries, table_format)
        loaded += len(paths)
    return loaded
