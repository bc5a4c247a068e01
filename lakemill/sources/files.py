"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.schemas import INDEX_SCHEMA, INGEST_TS, MISSION_SCHEMA
from lakemill.storage import file_selection


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Headed CSV from a file, a directory or a ``*`` pattern.

    Without a schema Spark infers one, which reads the files an extra time.  The
    header is checked against the schema in both cases, so files of another shape in the same
    directory fail instead of being misread.  ``multiline`` admits line breaks inside
    quoted fields at the price of one task per file.
    """
    target, options = file_selection(spark, path, ".csv", wildcards="*")
    reader = spark.read.options(
        header=True, enforceSchema=False, multiLine=multiline, escape='"', **options
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(target)


def read_flat_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flat mission rows from CSV, with empty fields as empty text as they were written."""
    return read_csv(spark, path, MISSION_SCHEMA, multiline=True).na.fill("")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def files_as_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Files queried in place from SQL."""
    return spark.sql(f"SELECT * FROM {file_format}.`{path}`")


def read_documents(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """One row per document file: ``file_path`` and the whole ``text``.

    A directory contributes the ``*.json`` files directly inside it.  No document at
    all is an error, raised before anything is written.
    """
    target, options = file_selection(spark, path, suffix, wildcards="*?[")
    # wholetext has to be the argument: its default overrides an option of that name
    files = spark.read.options(**options).text(target, wholetext=True)
    # the metadata path is percent-encoded; '+' is literal in a path
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    documents = files.select(F.url_decode(encoded).alias("file_path"), F.col("value").alias("text"))
    if documents.isEmpty():
        raise FileNotFoundError(f"no {suffix} documents in {path}")
    return documents


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index documents with their ``data`` array of ``{mission: url}`` entries."""
    return spark.read.schema(INDEX_SCHEMA).option("multiLine", True).json(path)


def ingest_stamp(df: DataFrame, column: str = INGEST_TS) -> DataFrame:
    """Add the processing time, one value per batch or micro-batch."""
    return df.withColumn(column, F.current_timestamp())
