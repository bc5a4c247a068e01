"""Raw layer: exports as they come, stamped with the load time."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lakemill.config import RetailRun
from lakemill.plans.together import together
from lakemill.schemas import RETAIL_COLUMNS, text_schema
from lakemill.sinks import append_table, create_schema, replace_table
from lakemill.sources import ingest_stamp, read_csv, read_table


def ingest_export(spark: SparkSession, run: RetailRun, name: str) -> None:
    """Load one export directory into its raw table."""
    schema = None if run.infer_schema else text_schema(RETAIL_COLUMNS[name])
    rows = ingest_stamp(read_csv(spark, f"{run.landing.rstrip('/')}/{name}", schema))
    write = append_table if run.bronze_mode == "append" else replace_table
    write(rows, run.table("bronze", name), run.table_format)


def build_bronze(spark: SparkSession, run: RetailRun) -> None:
    create_schema(spark, run.schema_of("bronze"))
    together(spark, (partial(ingest_export, spark, run, name) for name in RETAIL_COLUMNS))


def preview(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    """Any ``n`` rows."""
    return read_table(spark, table).limit(n)
