"""Table writers and table maintenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.operators.curve import along_curve
from lakemill.storage import copy_folder, folder_bytes, path_exists, swap_folders


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def append_table(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Append by column name, creating the table when it is missing."""
    df.write.format(table_format).mode("append").saveAsTable(table)


def replace_table(df: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Replace the data and the schema of a table that the query does not read itself."""
    df.write.format(table_format).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def create_table(spark: SparkSession, table: str, schema: StructType, table_format: str = "parquet") -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {table_format}")


def register_external(
    spark: SparkSession, table: str, path: str, table_format: str = "parquet", replace: bool = False
) -> None:
    """Register files as a table; ``replace`` drops the entry first so that it takes their schema."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {table_format} LOCATION {_literal(path)}")
    spark.catalog.refreshTable(table)


def comment_on(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_literal(comment)}")


def empty_table_like(
    spark: SparkSession, table: str, path: str, file_format: str = "parquet", table_format: str = "parquet"
) -> None:
    """Table without rows that has the schema of existing files; an existing table is kept."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} USING {table_format}"
        f" AS SELECT * FROM {file_format}.`{path}` WHERE 1 = 0"
    )


#: Largest size of the files that clustering aims at.
CLUSTERED_FILE_BYTES = 256 << 20
#: Size of files down to which a table is spread over all cores.
SPREAD_FILE_BYTES = 8 << 20


def clustered_files(size: int, cores: int) -> int:
    """Files of a clustered table of some bytes, each sorted and written by a task of its own.

    As many as there are cores, or a multiple of that where files would be too large, so that no core waits for the last ones.
    """
    files = max(cores, -(-size // CLUSTERED_FILE_BYTES))
    return max(1, min(-(-files // cores) * cores, -(-size // SPREAD_FILE_BYTES)))


def table_location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return details.first()["data_type"]


def _rewrite(
    spark: SparkSession,
    table: str,
    order: Callable[[DataFrame, int], DataFrame],
    partitions: int | None,
    table_format: str,
) -> None:
    """Write a table anew in some order, where it is.

    The rewrite goes to a folder beside the table's location, and the two change places by renaming.  If the job
    dies between the renames, both folders still hold every row.  The ledger of batches goes along.  The target of a
    stream that has its own log is refused before anything is touched, since its readers follow that log, not the folder.
    Nothing else may write to the table meanwhile.
    """
    location = table_location(spark, table)
    if path_exists(spark, f"{location}/_spark_metadata"):
        raise ValueError(f"{table} is the target of a stream; cluster a copy of it")
    if partitions is None:
        partitions = clustered_files(folder_bytes(spark, location), spark.sparkContext.defaultParallelism)
    staging, retired = f"{location}__clustering", f"{location}__before"
    # a listing from before other writers' files would lose them
    spark.catalog.refreshTable(table)
    order(spark.table(table), partitions).write.format(table_format).mode("overwrite").save(staging)
    for kept in ("_ledger", "_staged"):
        copy_folder(spark, f"{location}/{kept}", f"{staging}/{kept}")
    swap_folders(spark, location, staging, retired)
    spark.catalog.refreshTable(table)


def cluster_table(
    spark: SparkSession,
    table: str,
    columns: tuple[str, ...],
    partitions: int | None = None,
    table_format: str = "parquet",
) -> None:
    """Rewrite a table, managed or external, in range order of some columns, for tight file statistics of the first.

    There are :func:`clustered_files` unless ``partitions`` is given.  The row number of the scan is the last
    range key: it lets a value that fills a third of the table span several tasks, and it stays the same when a
    lost task is repeated.
    """

    def in_ranges(rows: DataFrame, n: int) -> DataFrame:
        numbered = rows.withColumn("_scan_row", F.monotonically_increasing_id())
        return numbered.repartitionByRange(n, *columns, "_scan_row").sortWithinPartitions(*columns).drop("_scan_row")

    _rewrite(spark, table, in_ranges, partitions, table_format)


def zorder_table(
    spark: SparkSession,
    table: str,
    columns: tuple[str, ...],
    partitions: int | None = None,
    table_format: str = "parquet",
) -> None:
    """Rewrite a table along a space-filling curve, for file statistics that are tight in each of the columns."""
    _rewrite(spark, table, lambda rows, n: along_curve(rows, columns, n), partitions, table_format)
