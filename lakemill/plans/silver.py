"""Conformed layer: typed columns and one row per key."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.config import RetailRun
from lakemill.functions import typed
from lakemill.operators.dedup import any_per_key, distinct_rows, latest_per_key
from lakemill.plans.together import together
from lakemill.schemas import INGEST_TS, SILVER_TYPES
from lakemill.sinks import create_schema, replace_table
from lakemill.sources import read_table


def silver_customers(bronze: DataFrame) -> DataFrame:
    return any_per_key(typed(bronze, SILVER_TYPES["customers"]), ["customer_id"])


def silver_products(bronze: DataFrame) -> DataFrame:
    return any_per_key(typed(bronze, SILVER_TYPES["products"]), ["product_id"])


def silver_orders(bronze: DataFrame) -> DataFrame:
    return latest_per_key(typed(bronze, SILVER_TYPES["orders"]), ["order_id"], INGEST_TS)


def silver_sales(bronze: DataFrame, dedupe: bool = False) -> DataFrame:
    """Typed sales lines; copies stay unless asked otherwise."""
    sales = typed(bronze, SILVER_TYPES["sales"])
    return latest_per_key(sales, ["sale_id"], INGEST_TS) if dedupe else sales


def distinct_orders(bronze: DataFrame) -> DataFrame:
    """Distinct (order, customer, date) triples, the short form of the orders table."""
    date = F.col("order_date").try_cast("date").alias("order_date")
    return distinct_rows(bronze, "order_id", "customer_id", date)


def build_silver(spark: SparkSession, run: RetailRun) -> None:
    create_schema(spark, run.schema_of("silver"))
    plans = {
        "customers": silver_customers,
        "products": silver_products,
        "orders": silver_orders,
        "sales": lambda bronze: silver_sales(bronze, run.dedupe_sales),
    }
    writes = (
        partial(
            replace_table,
            plan(read_table(spark, run.table("bronze", name))),
            run.table("silver", name),
            run.table_format,
        )
        for name, plan in plans.items()
    )
    together(spark, writes)
