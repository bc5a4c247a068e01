"""What the operators of this package share."""

from __future__ import annotations

import gc
import posixpath
import shutil
import tempfile
import weakref
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.storage import delete_path, shared_folder

#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Groups of which each may hold over a thousandth of all rows; there are never more of them.
HOT_GROUPS = 1000


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python functions import it; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='ship-')}/{package.name}", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write to the shared folder, with options of the writer, and read again: executors may go, the rows stay.

    The folders lie below ``spark.checkpoint.dir``; whoever owns that folder expires them.
    """
    path = posixpath.join(shared_folder(df.sparkSession, purpose), "rows")
    df.write.options(**options).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _KEPT[id(kept)] = (weakref.ref(kept), path)
    return kept


_KEPT: dict[int, tuple] = {}


def release(*tables: DataFrame) -> None:
    """Delete kept tables, whose readers have all been stored themselves; other DataFrames are left alone.

    What was made from a table no longer needs it once it is stored, so a lost executor does not either.
    """
    for df in tables:
        of, path = _KEPT.pop(id(df), (lambda: None, ""))
        if of() is df:
            delete_path(df.sparkSession, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It does when the driver's JVM collects garbage, which else may not come before much more is written.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def filled(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_key(*columns: str) -> Column:
    """128 bits of a row's id and text, never null; repeated rows share it."""
    parts = [p for c in columns for p in (F.col(c).isNull().cast("string"), filled(F.col(c).cast("string")))]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def hash_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, spread: Column) -> DataFrame:
    """Rows LEFT JOIN one-row-per-group facts on keys that are never null.

    The largest groups, a fixed number of small rows, are broadcast; every group beyond them
    has under a thousandth of the rows.  Rows of the large ones are dealt out by ``spread`` in the
    shuffle join, where they meet nothing.
    """
    facts = [c for c in groups.columns if c not in keys]
    hot = groups.orderBy(F.desc(size), *keys).limit(HOT_GROUPS)
    hot = hot.select(*keys, F.struct(*facts).alias("_hot"))
    dealt = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_slot", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(spread, F.lit(4096))).cast("int")
    )
    rest = groups.select(*keys, F.struct(*facts).alias("_cold"), F.lit(0).alias("_slot"))
    joined = dealt.join(rest, [*keys, "_slot"], "left").withColumn("_facts", F.coalesce("_hot", "_cold"))
    return joined.select(*rows.columns, *(F.col(f"_facts.{c}").alias(c) for c in facts))


#: Text that may be broadcast at once, of all rows together.
BROADCAST_BYTES = 16 << 20


def small_side(df: DataFrame) -> DataFrame:
    """Hint a broadcast where the rows, printed as JSON, measure under 16 MB; otherwise leave the join to shuffle."""
    columns = [f.name for f in df.schema]
    printed = F.to_json(F.struct(*columns))
    measured = df.agg(F.sum(F.octet_length(printed) + 64).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if (measured or 0) <= BROADCAST_BYTES else df


#: An aggregate, its column, and how two of its values add up.
Running = tuple[Callable[[Column], Column], Column, Callable[[Column, Column], Column]]


def running(
    rows: DataFrame, group: str, order: Sequence[str], results: dict[str, Running], purpose: str
) -> DataFrame:
    """Rows with running aggregates, inclusive, in the order inside each group, whatever a group's size.

    The rows are stored in range order of group (never null) and order; a window aggregates within a range, and what
    earlier ranges hold of the group is added.  Only the first and last group of a range can reach over its border,
    so this is at most two rows a range, and broadcast.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(group, *order, "_row").withColumn("_range", F.spark_partition_id())
    stored = keep(ranged, purpose)
    ends = stored.groupBy("_range").agg(F.array(F.min(group), F.max(group)).alias("ends"))
    border = F.broadcast(ends.select(F.explode("ends").alias(group)).distinct())
    whole = stored.join(border, group, "left_semi").groupBy("_range", group).agg(
        *(aggregate(column).alias(f"_{name}") for name, (aggregate, column, _) in results.items())
    )
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select(
        "_range", group, *(aggregate(F.col(f"_{name}")).over(earlier).alias(f"_{name}") for name, (aggregate, _, _) in results.items())
    )
    within = Window.partitionBy("_range", group).orderBy(*order, "_row").rowsBetween(Window.unboundedPreceding, 0)
    joined = stored.join(F.broadcast(before), ["_range", group], "left")
    return joined.select(
        *rows.columns,
        *(
            add(aggregate(column).over(within), F.coalesce(F.col(f"_{name}"), F.lit(0))).alias(name)
            for name, (aggregate, column, add) in results.items()
        ),
    )
