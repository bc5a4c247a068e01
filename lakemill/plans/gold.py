"""Business marts.

Each mart sums the sales lines per join key before it joins.  The partial aggregation
runs in the map tasks, so a key with a large share of the lines reaches the join as one
row, and the join reuses the partitioning of the sums.  The results equal those
of joining first, also for repeated or missing keys on either side.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.config import RetailRun
from lakemill.operators.topk import largest, top
from lakemill.plans.together import together
from lakemill.sinks import create_schema, replace_table
from lakemill.sources import read_table


def _money_sum(column: str) -> Column:
    """Sum of sums, in the type of a plain sum over decimal(18,2)."""
    return F.sum(column).cast("decimal(28,2)")


def order_totals(sales: DataFrame) -> DataFrame:
    """Revenue and number of lines per order."""
    return sales.groupBy("order_id").agg(
        F.sum("line_total").alias("order_revenue"), F.count("*").alias("order_lines")
    )


def sold_orders(orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Orders that have an id, each with its revenue and lines, which are NULL where it has none."""
    keyed = orders.select("order_id", "customer_id", "order_date").where(F.col("order_id").isNotNull())
    return keyed.join(order_totals(sales), "order_id", "left")


def daily_of(sold: DataFrame) -> DataFrame:
    """The daily mart from :func:`sold_orders`.

    An order of a day is counted with its first customer, so that a row per day and customer holds all four numbers;
    two distinct counts side by side would take every order three times.
    """
    first = F.row_number().over(Window.partitionBy("order_id", "order_date").orderBy("customer_id")) == 1
    per_customer = (
        sold.where(F.col("order_lines").isNotNull())
        .withColumn("first", first)
        .groupBy("order_date", "customer_id")
        .agg(F.sum("order_revenue").alias("revenue"), F.sum("order_lines").alias("lines"), F.count_if("first").alias("orders"))
    )
    return per_customer.groupBy("order_date").agg(
        _money_sum("revenue").alias("total_revenue"),
        F.sum("lines").alias("line_count"),
        F.sum("orders").alias("order_count"),
        F.count("customer_id").alias("unique_customers"),
    )


def daily_revenue(orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Revenue, lines, orders and customers per order date, over orders that have lines."""
    return daily_of(sold_orders(orders, sales))


def revenue_by_date(orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Only the revenue per order date."""
    totals = order_totals(sales).select("order_id", "order_revenue")
    sold = orders.select("order_id", "order_date").join(totals, "order_id")
    return sold.groupBy("order_date").agg(_money_sum("order_revenue").alias("total_revenue"))


def product_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        F.sum("quantity").alias("total_qty"), F.sum("line_total").alias("total_sales")
    )


def top_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and sales per product sold; a product unknown to the catalog has no name.

    The rows are not sorted, as a stored table has no order; see :func:`ranked_products`.
    """
    named = product_totals(sales).join(
        products.select("product_id", "product_name", "category"), "product_id", "left"
    )
    return named.groupBy("product_id", "product_name", "category").agg(
        F.sum("total_qty").alias("total_qty"), _money_sum("total_sales").alias("total_sales")
    )


def spending_of(customers: DataFrame, sold: DataFrame) -> DataFrame:
    """The customer mart from :func:`sold_orders`."""
    placed = sold.where(F.col("customer_id").isNotNull())
    per_customer = placed.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("order_revenue").alias("spend")
    )
    return (
        customers.join(per_customer, "customer_id", "left")
        .groupBy("customer_id", "first_name", "last_name", "email", "country")
        .agg(
            F.max(F.coalesce("orders", F.lit(0))).alias("lifetime_orders"),
            _money_sum("spend").alias("lifetime_spend"),
        )
    )


def customer_360(customers: DataFrame, orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Orders and spend per customer; without orders the count is 0 and the spend NULL."""
    return spending_of(customers, sold_orders(orders, sales))


def latest_days(mart: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` latest days of the daily revenue mart."""
    return top(mart, k, F.col("order_date").desc_nulls_last())


def ranked_products(mart: DataFrame, k: int | None = None) -> DataFrame:
    """The product mart by descending sales, optionally its first ``k`` rows."""
    return largest(mart, "total_sales", ["product_id", "product_name", "category"], k)


def build_gold(spark: SparkSession, run: RetailRun) -> None:
    create_schema(spark, run.schema_of("gold"))
    customers, products, orders, sales = (
        read_table(spark, run.table("silver", name))
        for name in ("customers", "products", "orders", "sales")
    )
    # two marts read the sums per order, which are made once
    sold = sold_orders(orders, sales).persist()
    marts = {
        "daily_revenue": daily_of(sold),
        "top_products": top_products(sales, products),
        "customer_360": spending_of(customers, sold),
    }
    writes = (
        partial(replace_table, mart, run.table("gold", name), run.table_format)
        for name, mart in marts.items()
    )
    try:
        together(spark, writes)
    finally:
        sold.unpersist()
