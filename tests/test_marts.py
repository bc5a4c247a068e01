"""Marts against the join-first form on random data with NULL, repeated and unknown keys."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from lakemill.plans import gold

CUSTOMERS = "customer_id long, first_name string, last_name string, email string, country string"
ORDERS = "order_id long, customer_id long, order_date date, order_status string"
PRODUCTS = "product_id long, product_name string, category string"
SALES = "sale_id long, order_id long, product_id long, quantity int, line_total decimal(18,2)"


@pytest.fixture(scope="module", params=[1, 2, 3])
def tables(spark, request):
    rng = random.Random(request.param)
    import datetime as dt

    def key(n):
        return rng.choice([None, *range(n)])

    days = [None, *(dt.date(2024, 3, d) for d in range(1, 5))]
    customers = [(key(12), rng.choice("AB"), None, rng.choice([None, "e"]), "UK") for _ in range(25)]
    customers += customers[:5]
    orders = [(key(30), key(15), rng.choice(days), "PAID") for _ in range(60)]
    products = [(key(8), rng.choice(["P", "Q"]), rng.choice([None, "C"])) for _ in range(10)]
    sales = [
        (i, key(40), key(12), rng.choice([None, 1, -2, 5]), rng.choice([None, Decimal("1.10"), Decimal("-3.33")]))
        for i in range(200)
    ]
    sales += [(1000 + i, 3, 2, 1, Decimal("0.01")) for i in range(150)]  # one order and product hold much of it
    return {
        "customers": spark.createDataFrame(customers, CUSTOMERS),
        "orders": spark.createDataFrame(orders, ORDERS),
        "products": spark.createDataFrame(products, PRODUCTS),
        "sales": spark.createDataFrame(sales, SALES),
    }


def joined_first(spark, tables, sql):
    for name, df in tables.items():
        df.createOrReplaceTempView(f"m_{name}")
    return rows(spark.sql(sql))


def test_daily_revenue(spark, tables):
    mart = gold.daily_revenue(tables["orders"], tables["sales"])
    assert dict(mart.dtypes)["total_revenue"] == "decimal(28,2)"
    assert rows(mart) == joined_first(spark, tables, """
        SELECT order_date, sum(line_total), count(*), count(DISTINCT o.order_id), count(DISTINCT customer_id)
        FROM m_orders o JOIN m_sales s ON o.order_id = s.order_id GROUP BY order_date""")
    revenue = gold.revenue_by_date(tables["orders"], tables["sales"])
    assert rows(revenue) == rows(mart.select("order_date", "total_revenue"))


def test_top_products(spark, tables):
    mart = gold.top_products(tables["sales"], tables["products"])
    assert dict(mart.dtypes)["total_sales"] == "decimal(28,2)" and dict(mart.dtypes)["total_qty"] == "bigint"
    assert rows(mart) == joined_first(spark, tables, """
        SELECT s.product_id, product_name, category, sum(quantity), sum(line_total)
        FROM m_sales s LEFT JOIN m_products p ON s.product_id = p.product_id
        GROUP BY s.product_id, product_name, category""")


def test_customer_360(spark, tables):
    mart = gold.customer_360(tables["customers"], tables["orders"], tables["sales"])
    assert dict(mart.dtypes)["lifetime_spend"] == "decimal(28,2)"
    assert rows(mart) == joined_first(spark, tables, """
        SELECT c.customer_id, first_name, last_name, email, country, count(DISTINCT o.order_id), sum(line_total)
        FROM m_customers c LEFT JOIN m_orders o ON c.customer_id = o.customer_id
        LEFT JOIN m_sales s ON o.order_id = s.order_id
        GROUP BY c.customer_id, first_name, last_name, email, country""")


def test_reports(tables):
    mart = gold.daily_revenue(tables["orders"], tables["sales"])
    days = [r.order_date for r in gold.latest_days(mart, 2).collect()]
    assert days == sorted(days, reverse=True) and len(days) == 2
    ranked = [r.total_sales for r in gold.ranked_products(gold.top_products(tables["sales"], tables["products"])).collect()]
    known = [v for v in ranked if v is not None]
    assert known == sorted(known, reverse=True)


def test_empty_tables(tables):
    none = tables["sales"].where(F.lit(False))
    assert gold.daily_revenue(tables["orders"], none).count() == 0
    assert {r.lifetime_spend for r in gold.customer_360(tables["customers"], tables["orders"], none).collect()} == {None}


def test_the_daily_mart_does_not_copy_its_orders(tables):
    assert "Expand" not in plan_of(gold.daily_revenue(tables["orders"], tables["sales"]))


def test_an_order_of_several_customers_counts_once_a_day(spark):
    import datetime as dt

    day = dt.date(2024, 3, 1)
    orders = spark.createDataFrame([(1, 7, day, ""), (1, 8, day, ""), (1, 8, day, ""), (1, None, None, ""), (None, 9, day, "")], ORDERS)
    sales = spark.createDataFrame([(1, 1, 1, 1, Decimal("1.00")), (2, None, 1, 1, Decimal("5.00"))], SALES)
    assert rows(gold.daily_revenue(orders, sales)) == [
        (None, Decimal("1.00"), 1, 1, 0), (day, Decimal("3.00"), 3, 1, 2),
    ]
