"""Fixed schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the retail exports.
RETAIL_COLUMNS = {
    "customers": ("customer_id", "first_name", "last_name", "email", "signup_date", "country"),
    "products": ("product_id", "product_name", "category", "list_price", "is_active"),
    "orders": ("order_id", "customer_id", "order_date", "order_status"),
    "sales": (
        "sale_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total",
    ),
}

# The types the silver layer gives to non-text columns.
SILVER_TYPES = {
    "customers": {"customer_id": "bigint", "signup_date": "date"},
    "products": {"product_id": "bigint", "list_price": "decimal(18,2)", "is_active": "boolean"},
    "orders": {"order_id": "bigint", "customer_id": "bigint", "order_date": "date"},
    "sales": {
        "sale_id": "bigint",
        "order_id": "bigint",
        "product_id": "bigint",
        "quantity": "int",
        "unit_price": "decimal(18,2)",
        "discount_pct": "decimal(5,2)",
        "line_total": "decimal(18,2)",
    },
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "sales": "sale_id",
}

INGEST_TS = "_ingest_ts"

# Columns of a flat mission row, in file order.
MISSION_COLUMNS = (
    "mission_identifier", "startDate", "endDate", "institution", "role", "firstName", "lastName",
)
MISSION_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in MISSION_COLUMNS])

INDEX_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("mission", T.StringType())]))),
])

DQ_RESULTS_SCHEMA = T.StructType([
    T.StructField("check_ts", T.TimestampType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("bad_count", T.LongType()),
])


def text_schema(columns) -> T.StructType:
    """All-text schema for reading raw exports without an inference pass."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
