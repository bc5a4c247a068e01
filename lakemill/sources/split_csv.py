"""CSV with line breaks inside quoted fields, read by as many tasks as its files have splits.

Files are read as lines.  A line starts a record when the quotes before it in its file are even in number: quotes are
counted per split, a running sum over the splits of a file tells each one whether it begins inside a field, and a
running sum over its lines does the rest.  Lines are shuffled once, by split; only records that cross a border
between splits meet again.  Then each record is parsed by itself.

A quote stands around a field or is doubled inside one; files with lone quotes inside unquoted fields need
``read_csv(..., multiline=True)``, one task per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.storage import file_selection

_SPLIT = ["file", "split"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` with its ``file``, the place of its ``split`` and ``nth``, its order there, and the ``quotes`` in it."""
    target, options = file_selection(spark, path, ".csv", wildcards="*")
    read = spark.read.options(lineSep="\n", **options).text(target)
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).cast("bigint").alias("quotes"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records as ``file``, ``record`` and whether it is the first one of its file, its ``header``."""
    lines = _lines(spark, path)
    totals = lines.groupBy(*_SPLIT).agg(F.sum("quotes").alias("in_split"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opened = totals.select(*_SPLIT, F.coalesce(F.sum("in_split").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy(*_SPLIT).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.join(opened, _SPLIT).withColumn("after", F.sum("quotes").over(inside) + F.col("earlier"))
    starts = (F.col("after") - F.col("quotes")) % 2 == 0
    # the line that a record starts with names it; a split that begins inside a record has lines without a name
    named = counted.withColumns({
        "at": F.last(F.when(starts, F.col("nth")), ignorenulls=True).over(inside),
        "first": (F.col("split") == 0) & (F.min("nth").over(inside) == F.col("nth")),
    })
    pieces = named.groupBy(*_SPLIT, "at").agg(
        _joined("nth", "line"), F.max("first").alias("header"), (F.max_by("after", "nth") % 2 == 1).alias("open")
    )
    cut = F.col("at").isNull() | F.col("open")
    # over the border: the open end of a split, then splits that have no start before its end
    order = Window.partitionBy("file").orderBy("split", F.col("at").asc_nulls_first())
    owner = F.last(F.when(F.col("at").isNotNull(), F.col("split")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    over = pieces.where(cut).withColumn("owner", owner).groupBy("file", "owner").agg(
        _joined("split", "record"), F.max("header").alias("header")
    )
    return pieces.where(~cut).select("file", "record", "header").unionByName(over.select("file", "record", "header"))


def _joined(order: str, text: str) -> Column:
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(parts, lambda p: p[text]), "\n").alias("record")


def read_split_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headed CSV of a schema from a file, a directory or a ``*`` pattern; fields may hold line breaks.

    A file whose header is not the schema's columns fails the job.  Empty lines between records are skipped.
    """
    found = records(spark, path).withColumn("record", F.regexp_replace("record", "\r$", ""))
    bare = F.replace(F.regexp_replace("record", "^\ufeff", ""), F.lit('"'))
    wrong = F.raise_error(F.concat(F.col("file"), F.lit(" has another header: "), F.col("record")))
    body = F.when(~F.col("header"), F.col("record")).when(bare != ",".join(schema.names), wrong)
    rows = found.select(body.alias("record")).where(F.trim("record") != "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv("record", columns, {"escape": '"', "multiLine": "true"})
    return rows.select(parsed.alias("row")).select("row.*")
