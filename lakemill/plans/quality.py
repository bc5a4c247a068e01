"""Data-quality battery over the layers.

Checks on one table share one scan of it.  A check yields either one row of counts or
the differing groups; :func:`log_entries` turns counts into stored PASS/FAIL results.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.config import RetailRun
from lakemill.functions import conditional_sum, line_total_error, pass_or_fail
from lakemill.operators.relate import (
    differing_groups,
    orphan_count,
    row_counts,
    union_distinct,
    union_labelled,
)
from lakemill.operators.topk import counted, largest, top
from lakemill.plans.gold import order_totals, product_totals, revenue_by_date
from lakemill.schemas import DQ_RESULTS_SCHEMA, PRIMARY_KEYS
from lakemill.sinks import append_table, create_schema, create_table
from lakemill.sources import read_table

# Fixed value: amounts may differ by this much.
TOLERANCE = Decimal("0.01")


def layer_row_counts(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each entity in both layers; silver should not exceed bronze."""
    raw = row_counts(bronze, "bronze_cnt").withColumn("silver_cnt", F.lit(0).cast("bigint"))
    conformed = row_counts(silver, "silver_cnt").withColumn("bronze_cnt", F.lit(0).cast("bigint"))
    return raw.unionByName(conformed).groupBy("entity").agg(
        F.sum("bronze_cnt").alias("bronze_cnt"), F.sum("silver_cnt").alias("silver_cnt")
    )


def distinct_row_counts(*tables: DataFrame) -> DataFrame:
    """Set of the row counts: equal counts collapse into one row."""
    return union_distinct([df.agg(F.count("*").alias("row_count")) for df in tables])


def sales_rules() -> dict[str, Column]:
    """What counts as a bad number in a sales line (fixed values)."""
    return {
        "bad_qty": F.col("quantity") <= 0,
        "bad_unit_price": F.col("unit_price") < 0,
        "bad_discount": (F.col("discount_pct") < 0) | (F.col("discount_pct") > 1),
        "bad_line_total": F.col("line_total") < 0,
    }


def table_profile(
    df: DataFrame, table: str, key: str, rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Row count, distinct and missing keys and rule violations of a table in one pass.

    Columns not selected afterwards are not computed, so single checks are projections
    of this plan.
    """
    violations = [conditional_sum(rule).alias(name) for name, rule in (rules or {}).items()]
    return df.agg(
        F.count("*").alias("total"),
        F.countDistinct(key).alias("distinct_ids"),
        F.count_if(F.col(key).isNull()).alias("null_ids"),
        *violations,
    ).withColumns({"table_name": F.lit(table), "check_name": F.lit(f"{table}.{key}")})


def _profiles(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [table_profile(df, name, PRIMARY_KEYS[name]) for name, df in tables.items()]


def missing_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without a primary key, per table."""
    return union_labelled(
        [p.select("check_name", F.col("null_ids").alias("bad")) for p in _profiles(tables)]
    )


def key_uniqueness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys per table; NULL keys count as rows only."""
    return union_labelled(
        [p.select("table_name", "total", "distinct_ids") for p in _profiles(tables)]
    )


def orphan_orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orphan_count(orders, customers, "customer_id", "orphan_orders_customers", True)


def orphan_sales_orders(sales: DataFrame, orders: DataFrame) -> DataFrame:
    return orphan_count(sales, orders, "order_id", "orphan_sales_orders", True)


def orphan_sales_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    return orphan_count(sales, products, "product_id", "orphan_sales_products", True)


def status_profile(orders: DataFrame) -> DataFrame:
    """Orders per status, most frequent first."""
    return largest(counted(orders, "order_status", "cnt"), "cnt", ["order_status"])


def numeric_sanity(sales: DataFrame) -> DataFrame:
    """Bad numbers per rule; a NULL number is not bad, and an empty table gives NULL."""
    return sales.agg(*(conditional_sum(rule).alias(name) for name, rule in sales_rules().items()))


def mismatched_line_totals(sales: DataFrame) -> DataFrame:
    """Lines whose total is off by more than a cent; lines with a NULL in it do not count."""
    wrong = sales.where(line_total_error() > F.lit(TOLERANCE))
    return wrong.agg(F.count("*").alias("mismatched_lines"))


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def reconcile_daily(mart: DataFrame, orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Days whose stored revenue differs from the silver sum by more than a cent."""
    expected = revenue_by_date(orders, sales).withColumnRenamed("total_revenue", "silver_revenue")
    stored = mart.select("order_date", F.col("total_revenue").alias("gold_revenue"))
    diff = _or_zero("silver_revenue") - _or_zero("gold_revenue")
    different = differing_groups(
        expected, stored, "order_date", F.abs(diff) > F.lit(TOLERANCE)
    )
    return different.select("order_date", "silver_revenue", "gold_revenue", diff.alias("diff"))


def _stored_products(mart: DataFrame) -> DataFrame:
    return mart.select(
        "product_id", F.col("total_qty").alias("gold_qty"), F.col("total_sales").alias("gold_sales")
    )


def _product_differs() -> Column:
    gap = F.abs(_or_zero("silver_sales") - _or_zero("gold_sales"))
    return (gap > F.lit(TOLERANCE)) | (_or_zero("silver_qty") != _or_zero("gold_qty"))


def reconcile_products(mart: DataFrame, sales: DataFrame) -> DataFrame:
    """Products whose stored quantity or sales differ from the silver sums."""
    expected = product_totals(sales).withColumnsRenamed(
        {"total_qty": "silver_qty", "total_sales": "silver_sales"}
    )
    different = differing_groups(expected, _stored_products(mart), "product_id", _product_differs())
    return different.select("product_id", "silver_qty", "gold_qty", "silver_sales", "gold_sales")


def bad_rows(df: DataFrame, bad: Column) -> DataFrame:
    """Number of rows where the condition holds, as one row."""
    return df.where(bad).agg(F.count("*").alias("bad_count"))


def _check_time(as_of: datetime | str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def log_entries(
    counts: DataFrame, checks: Mapping[tuple[str, str, str], str], as_of: datetime | str | None = None
) -> DataFrame:
    """Result rows from one row of counts; ``checks`` maps (layer, table, check) to the count column."""
    found = (
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.coalesce(column, F.lit(0)).cast("bigint").alias("bad_count"),
        )
        for (layer, table, check), column in checks.items()
    )
    return counts.select(F.inline(F.array(*found))).select(
        _check_time(as_of).alias("check_ts"),
        "layer",
        "table_name",
        "check_name",
        pass_or_fail(F.col("bad_count")).alias("status"),
        "bad_count",
    )


def silver_checks(
    orders: DataFrame, sales: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    """The stored checks of the silver layer."""
    checks = {
        ("silver", "orders", "order_id_not_null"): bad_rows(orders, F.col("order_id").isNull()),
        ("silver", "sales", "line_total_not_null"): bad_rows(sales, F.col("line_total").isNull()),
        ("silver", "sales", "orphan_sales_orders"): orphan_sales_orders(sales, orders),
    }
    return union_labelled(
        [log_entries(count, {check: F.col(count.columns[0])}, as_of) for check, count in checks.items()]
    )


def _order_checks(mart: DataFrame, orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Orphaned sales lines and differing days in one pass over the sales, as one row.

    Same counts as :func:`orphan_sales_orders` and :func:`reconcile_daily`.  Lines without
    an order have no ``known`` and so match no stored day.
    """
    known = orders.select("order_id", "order_date", F.lit(True).alias("known"))
    by_day = (
        order_totals(sales)
        .join(known, "order_id", "left")
        .groupBy("known", "order_date")
        .agg(F.sum("order_revenue").alias("silver"), F.sum("order_lines").alias("lines"))
    )
    stored = mart.select("order_date", F.col("total_revenue").alias("gold"), F.lit(True).alias("known"))
    drift = F.abs(_or_zero("silver") - _or_zero("gold")) > F.lit(TOLERANCE)
    return by_day.join(stored, ["known", "order_date"], "full_outer").agg(
        F.sum(F.when(F.col("known").isNull(), F.col("lines"))).alias("orphans"),
        F.count_if(F.col("known").isNotNull() & drift).alias("days"),
    )


def _product_checks(mart: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales lines without a product and differing products in one pass over the sales, as one row.

    Same counts as :func:`orphan_sales_products` and :func:`reconcile_products`.
    """
    sums = sales.groupBy("product_id").agg(
        F.sum("quantity").alias("silver_qty"), F.sum("line_total").alias("silver_sales"), F.count("*").alias("lines")
    )
    known = products.select("product_id").distinct().withColumn("known", F.lit(True))
    both = sums.join(known, "product_id", "left").join(_stored_products(mart), "product_id", "full_outer")
    return both.agg(
        F.sum(F.when(F.col("known").isNull(), F.col("lines"))).alias("orphans"),
        F.count_if(_product_differs()).alias("products"),
    )


def battery(
    silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame], as_of: datetime | str | None = None
) -> DataFrame:
    """Every check with a pass rule as result rows.

    All checks on the columns of a table share one scan, and so do the two checks that follow
    the sales lines to their orders, and the two that follow them to their products: three passes over the sales.
    """
    entries = []
    for name, df in silver.items():
        key = PRIMARY_KEYS[name]
        rules = {}
        if name == "sales":
            rules = sales_rules() | {
                "line_total_not_null": F.col("line_total").isNull(),
                "line_total_mismatch": line_total_error() > F.lit(TOLERANCE),
            }
        columns = {
            f"{key}_not_null": F.col("null_ids"),
            f"{key}_unique": F.col("total") - F.col("distinct_ids"),
            **{rule: F.col(rule) for rule in rules},
        }
        checks = {("silver", name, check): column for check, column in columns.items()}
        entries.append(log_entries(table_profile(df, name, key, rules), checks, as_of))

    orders, sales = silver["orders"], silver["sales"]
    customers_missing = orphan_orders_customers(orders, silver["customers"])
    return union_labelled([
        *entries,
        log_entries(
            customers_missing,
            {("silver", "orders", "orphan_orders_customers"): F.col("orphan_orders_customers")},
            as_of,
        ),
        log_entries(
            _order_checks(gold["daily_revenue"], orders, sales),
            {
                ("silver", "sales", "orphan_sales_orders"): F.col("orphans"),
                ("gold", "daily_revenue", "daily_revenue_matches_silver"): F.col("days"),
            },
            as_of,
        ),
        log_entries(
            _product_checks(gold["top_products"], silver["products"], sales),
            {
                ("silver", "sales", "orphan_sales_products"): F.col("orphans"),
                ("gold", "top_products", "top_products_matches_silver"): F.col("products"),
            },
            as_of,
        ),
    ])


def store_results(entries: DataFrame, table: str, table_format: str = "parquet") -> None:
    """Append result rows by name to the result log, creating it when it is missing."""
    create_table(entries.sparkSession, table, DQ_RESULTS_SCHEMA, table_format)
    append_table(entries, table, table_format)


def latest_results(results: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` latest result rows."""
    ties = [F.col(c) for c in ("layer", "table_name", "check_name", "status", "bad_count")]
    return top(results, k, F.col("check_ts").desc_nulls_last(), *ties)


def run_battery(spark: SparkSession, run: RetailRun) -> None:
    """Check the stored layers and log the results."""
    silver = {name: read_table(spark, run.table("silver", name)) for name in PRIMARY_KEYS}
    gold = {
        name: read_table(spark, run.table("gold", name)) for name in ("daily_revenue", "top_products")
    }
    create_schema(spark, run.schema_of("silver"))
    store_results(battery(silver, gold), run.results_table, run.table_format)


def store_silver_checks(spark: SparkSession, run: RetailRun) -> None:
    """Log the checks that belong to building the silver layer."""
    orders, sales = (read_table(spark, run.table("silver", name)) for name in ("orders", "sales"))
    store_results(silver_checks(orders, sales), run.results_table, run.table_format)
