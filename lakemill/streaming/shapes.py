"""Arriving Parquet files whose shape changes, with no schema given.

The table's own schema is the ledger of what has been seen.  Files are grouped by the shape in their footers, which
tasks read, and each group is read once.  Columns that the table lacks are added to it; columns that a file lacks are NULL.
A value that does not fit the type of its column is kept, as text, in the JSON of the rescue column, beside the path of
its file, and its column is NULL.  Files are taken once, by the ledger of :mod:`lakemill.sinks.ledger`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from lakemill.sinks.ledger import add_once, repair
from lakemill.sinks.tables import create_table
from lakemill.sources.files import ingest_stamp
from lakemill.storage import escape_glob
from lakemill.streaming.ingest import new_files

RESCUED = "_rescued"
FILE = "_file_path"
STAMP = "ingest_ts"
_WIDER = ([ByteType, ShortType, IntegerType, LongType], [FloatType, DoubleType])
_NESTED = (StructType, ArrayType, MapType)
_SHAPES = pa.schema([("path", pa.string()), ("shape", pa.string())])


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    from pyarrow import parquet as pq

    for batch in batches:
        paths = batch.column("path").to_pylist()
        shapes = []
        for path in paths:
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as stream:
                shapes.append(pq.read_schema(stream).remove_metadata().to_string(show_field_metadata=False))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(shapes, pa.string())], schema=_SHAPES)


def by_shape(files: DataFrame) -> list[list[str]]:
    """Paths of Parquet files, grouped by the shape that their footers state; groups and paths in order."""
    spread = files.select("path").repartition(files.sparkSession.sparkContext.defaultParallelism)
    groups: dict[str, list[str]] = {}
    for row in sorted(spread.mapInArrow(_footers, "path string, shape string").collect()):
        groups.setdefault(row["shape"], []).append(row["path"])
    return list(groups.values())


def _widens(have: DataType, want: DataType) -> bool:
    return have == want or any(
        type(have) in kinds and type(want) in kinds and kinds.index(type(have)) <= kinds.index(type(want))
        for kinds in _WIDER
    )


def fitted(column: Column, have: DataType, want: DataType) -> tuple[Column, Column]:
    """A value in the wanted type, NULL where it does not fit exactly, and then its text, else NULL."""
    nothing = F.lit(None).cast("string")
    if _widens(have, want):
        return column.cast(want), nothing
    text = F.to_json(column) if isinstance(have, _NESTED) else column.cast("string")
    if isinstance(want, StringType):
        return text, nothing
    if isinstance(want, _NESTED) or isinstance(have, _NESTED):
        return F.lit(None).cast(want), text
    value = text.try_cast(want)
    fits = F.coalesce(value.cast("string") == text, F.lit(False))
    return F.when(fits, value), F.when(~fits, text)


def fit_rows(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of files in the columns of a schema, what does not fit in its rescue column."""
    have = {f.name.lower(): f for f in rows.schema}
    values, rescued = [], []
    for field in schema:
        own = have.get(field.name.lower())
        if field.name in (RESCUED, STAMP):
            continue
        if own is None:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, left = fitted(F.col(f"`{own.name}`"), own.dataType, field.dataType)
        values.append(value.alias(field.name))
        rescued.append(F.struct(F.lit(field.name).alias("key"), left.alias("value")))
    kept = F.filter(F.array(*rescued), lambda r: r["value"].isNotNull())
    named = F.concat(kept, F.array(F.struct(F.lit(FILE).alias("key"), F.col("_metadata.file_path").alias("value"))))
    rescue = F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(named)))
    return rows.select(*values, rescue.alias(RESCUED))


def _added(known: StructType, seen: StructType) -> list[StructField]:
    names = {f.name.lower() for f in known}
    return [StructField(f.name, f.dataType) for f in seen if f.name.lower() not in names]


def ingest_shapes(spark: SparkSession, path: str, table: str, max_files: int = 10_000, table_format: str = "parquet") -> int:
    """Append the files under a path that were not taken before, whatever their columns; how many there were.

    A missing table is made from the first files.  Rows are stamped with ``ingest_ts``.  At most ``max_files`` are one
    batch, whose paths alone come to the driver.
    """
    if spark.catalog.tableExists(table):
        repair(spark, table, "load-")
    taken = 0
    while True:
        entries = new_files(spark, path, table, max_files)
        if entries is None:
            return taken
        groups = [spark.read.parquet(*map(escape_glob, paths)) for paths in by_shape(entries)]
        extra = [StructField(RESCUED, StringType()), *ingest_stamp(spark.range(0), STAMP).schema.fields[1:]]
        exists = spark.catalog.tableExists(table)
        known = spark.table(table).schema if exists else StructType()
        added = reduce(lambda found, group: [*found, *_added(StructType([*known, *found]), group.schema)], groups, [])
        if not exists:
            create_table(spark, table, StructType([*added, *extra]), table_format)
        else:
            added += _added(StructType([*known, *added]), StructType(extra))
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        schema = spark.table(table).schema
        rows = reduce(DataFrame.unionByName, (fit_rows(group, schema) for group in groups))
        add_once(ingest_stamp(rows, STAMP), table, f"load-{uuid.uuid4().hex}", entries, table_format)
        taken += entries.count()
