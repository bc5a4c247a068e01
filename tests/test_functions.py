from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from lakemill import functions as f


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values) or "x int")
    return df.select(column.alias("v")).first().v


def test_typed_turns_malformed_values_into_null(spark):
    df = spark.createDataFrame(
        [("1", "2024-02-29", "12.345", "True"), ("x", "2024-02-30", "", "maybe"), (None, None, None, None)],
        "id string, day string, price string, flag string",
    )
    typed = f.typed(df, {"id": "bigint", "day": "date", "price": "decimal(18,2)", "flag": "boolean"})
    assert [t.dataType.simpleString() for t in typed.schema] == ["bigint", "date", "decimal(18,2)", "boolean"]
    assert [tuple(r) for r in typed.collect()] == [
        (1, date(2024, 2, 29), Decimal("12.35"), True),
        (None, None, None, None),
        (None, None, None, None),
    ]


def test_us_date(spark):
    assert one(spark, f.us_date("d"), d="07/31/1992") == date(1992, 7, 31)
    assert one(spark, f.us_date("d"), d="") is None
    assert one(spark, f.us_date("d"), d="1992-07-31") is None


def test_full_name_skips_null_and_keeps_empty_parts(spark):
    assert one(spark, f.full_name("a", "b"), a="Ada", b="One") == "Ada One"
    assert one(spark, f.full_name("a", "b"), a=None, b="One") == "One"
    assert one(spark, f.full_name("a", "b"), a="", b="") == " "
    assert one(spark, f.full_name("a", "b", trim=True), a="", b="") == ""
    assert one(spark, f.full_name("a", "b"), a=None, b=None) == ""


def test_is_missing_is_never_null(spark):
    assert [one(spark, f.is_missing("a"), a=v) for v in (None, "", " ", "x")] == [True, True, False, False]


def test_last_url_segment(spark):
    url = "https://example.com/api/One%20Two%2B+"
    assert one(spark, f.last_url_segment("u"), u=url) == "One%20Two%2B+"
    assert one(spark, f.last_url_segment("u", decode=True), u=url) == "One Two++"
    assert one(spark, f.last_url_segment("u"), u='"https://example.com/x"') == "x"
    assert one(spark, f.last_url_segment("u"), u="plain") == "plain"
    assert one(spark, f.last_url_segment("u"), u="https://example.com/") == ""


def test_line_total_error_is_exact(spark):
    df = spark.sql(
        "SELECT 3 AS quantity, cast(861.84 AS decimal(18,2)) AS unit_price, cast(0.05 AS decimal(5,2)) AS discount_pct,"
        " cast(2456.24 AS decimal(18,2)) AS line_total"
    )
    assert df.select(f.line_total_error()).first()[0] == Decimal("0.0040")


def test_conditional_sum(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    assert df.agg(f.conditional_sum(F.col("x") < 0)).first()[0] == 1
    assert df.where("x > 5").agg(f.conditional_sum(F.col("x") < 0)).first()[0] is None


def test_pass_or_fail(spark):
    status = spark.range(1).select(f.pass_or_fail(F.lit(0)), f.pass_or_fail(F.lit(3))).first()
    assert tuple(status) == ("PASS", "FAIL")
