"""Path writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from lakemill.operators.flatten import flat_columns
from lakemill.plans.together import together
from lakemill.sources.files import read_csv
from lakemill.storage import delete_path, escape_glob, file_selection, move_file, path_exists


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def write_path(df: DataFrame, path: str, mode: str = "overwrite", file_format: str = "parquet") -> None:
    """Write to a path; the schema may change on overwrite only.

    Plain files accept any schema on append and break their readers later, so an
    append to existing files of another shape is refused here.
    """
    spark = df.sparkSession
    if mode == "append" and path_exists(spark, path):
        present = spark.read.format(file_format).load(escape_glob(path)).schema
        if _shape(present) != _shape(df.schema):
            raise ValueError(f"{path} holds {_shape(present)}, cannot append {_shape(df.schema)}")
    df.write.format(file_format).mode(mode).save(path)


def export_parquet(df: DataFrame, path: str) -> None:
    """Replace a directory by the Parquet copy of a table or query."""
    df.write.mode("overwrite").parquet(path)


#: Rows of a flat CSV file, which one task reads since its fields may hold line breaks.
FLAT_FILE_ROWS = 1_000_000


def write_csv(rows: DataFrame, path: str, partition_by: Sequence[str] = (), **options) -> None:
    """Headed CSV as :func:`lakemill.sources.read_csv` reads it: doubled quotes, every blank kept."""
    rows.write.mode("overwrite").partitionBy(*partition_by).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options
    ).csv(path)


def write_flat_csv(rows: DataFrame, path: str) -> None:
    """Flat mission rows as headed CSV with minimal quoting; no rows still give a header.

    Files hold at most ``FLAT_FILE_ROWS`` rows.
    """
    write_csv(flat_columns(rows), path, emptyValue="", nullValue="", maxRecordsPerFile=FLAT_FILE_ROWS)


def write_flat_parquet(rows: DataFrame, path: str) -> None:
    export_parquet(flat_columns(rows), path)


def _file_name() -> Column:
    # the name on the metadata path is percent-encoded; '+' is literal in it
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


# a file of any name, as a folder's
_KEY = "_file_md5"


def _file_key() -> Column:
    return F.md5(F.col("_metadata.file_path")).alias(_KEY)


def _csv_files(spark: SparkSession, source: str) -> DataFrame:
    """``path``, ``name`` and a key of the CSV files; equal names in several folders are refused, as their results would meet."""
    selected, options = file_selection(spark, source, ".csv", wildcards="*")
    listing = spark.read.format("binaryFile").options(**options).load(selected)
    files = listing.select("path", F.regexp_replace(_file_name(), r"\.csv$", "").alias("name"), _file_key())
    twice = files.groupBy("name").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"several files of {source} are named {', '.join(sorted(r['name'] for r in twice))}")
    return files


def convert_csv(
    spark: SparkSession, source: str, target: str, schema: StructType | None = None
) -> None:
    """Convert all CSV files of one shape in a single job, one ``file=<name>.csv`` folder per file.

    The name without its ending is also the column ``source``, always text.
    """
    _csv_files(spark, source)
    name = _file_name()
    table = read_csv(spark, source, schema).select(
        "*", F.regexp_replace(name, r"\.csv$", "").alias("source"), name.alias("file")
    )
    table.write.mode("overwrite").partitionBy("file").parquet(target)


def _header_reader():
    """Reads the first line of each file, no more than its first blocks; made here, so that executors need no package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = []
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(quote(path, safe="/:"))
                with store.open_input_stream(name, compression=None) as stream:
                    line = b""
                    while b"\n" not in line and (block := stream.read(1 << 13)):
                        line += block
                lines.append(line.split(b"\n")[0].rstrip(b"\r").decode("utf-8-sig", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.string())], names=["path", _KEY, "header"])

    return run


#: Types in the order they are tried, and the form of their values.
_FORMS = {
    "int": r"^[+-]?\d+$", "bigint": r"^[+-]?\d+$", "decimal(38,0)": r"^[+-]?\d+$",
    "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}", "boolean": r"^(?i)(true|false)$",
}


def _type_of(column: Column) -> Column:
    """The first type that all values of a group fit, as text; empty ones fit any, and nothing else is text."""
    fits = {t: column.rlike(form) & column.try_cast(t).isNotNull() for t, form in _FORMS.items()}
    first = F.coalesce(*(F.when(F.bool_and(column.isNull() | fit), t) for t, fit in fits.items()), F.lit("string"))
    return F.when(F.count(column) == 0, "string").otherwise(first)


def _files_of_rows(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read.options(header=True, escape='"')
    rows = (reader.schema(schema) if schema is not None else reader).csv([escape_glob(path) for path in paths])
    return rows.select("*", _file_key())


def _by_types(spark: SparkSession, keys: Mapping[str, str]) -> list[tuple[StructType, list[str]]]:
    """Paths of files of one header (with their keys), by the types of their columns."""
    rows = _files_of_rows(spark, list(keys))
    names = rows.columns[:-1]
    columns = (F.col(f"`{name.replace('`', '``')}`") for name in names)
    types = rows.groupBy(_KEY).agg(F.array(*map(_type_of, columns)).alias("types"))
    found = {r[_KEY]: tuple(r["types"]) for r in types.collect()}
    groups: dict[tuple, list[str]] = {}
    for path, key in keys.items():
        groups.setdefault(found.get(key, ("string",) * len(names)), []).append(path)
    return [
        (StructType([StructField(n, DataType.fromDDL(t)) for n, t in zip(names, kinds, strict=True)]), members)
        for kinds, members in groups.items()
    ]


def convert_each_csv(spark: SparkSession, source: str, target: str) -> list[str]:
    """Convert CSV files of different shapes, each to ``<target>/<name>.parquet``.

    Tasks read the first line of every file; the files of one header are read together to find the types of each file's
    columns, and those of equal header and types are written by one job, whose folders are then renamed: the number
    of jobs follows the shapes and not the files.  A file without rows has columns of text, an empty one
    gives nothing, and one whose first line is blank is refused before anything is written.  Only paths, headers and types
    come to the driver; use :func:`convert_csv` for many files of one shape.
    """
    files = _csv_files(spark, source)
    spread = files.select("path", _KEY).repartition(spark.sparkContext.defaultParallelism)
    read = sorted(spread.mapInArrow(_header_reader(), f"path string, {_KEY} string, header string").collect())
    by_header: dict[str, dict[str, str]] = {}
    for path, key, header in read:
        if not header:
            raise ValueError(f"{path} has no header")
        by_header.setdefault(header, {})[path] = key
    target = target.rstrip("/")
    outputs = {r["path"]: f"{target}/{r['path'].rsplit('/', 1)[-1].removesuffix('.csv')}.parquet" for r in read}
    together(spark, (partial(_convert, spark, keys, outputs, target) for keys in by_header.values()))
    return list(outputs.values())


def _convert(spark: SparkSession, keys: Mapping[str, str], outputs: Mapping[str, str], target: str) -> None:
    for schema, members in _by_types(spark, keys):
        staged = f"{target}/_staged-{uuid.uuid4().hex}"
        _files_of_rows(spark, members, schema).write.partitionBy(_KEY).parquet(staged)
        for path in members:
            folder = f"{staged}/{_KEY}={keys[path]}"
            delete_path(spark, outputs[path])
            if path_exists(spark, folder):
                move_file(spark, folder, outputs[path])
            else:
                export_parquet(spark.createDataFrame([], schema), outputs[path])
        delete_path(spark, staged)
