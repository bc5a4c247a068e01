"""Acceptance numbers on external sample data, read in place when folders are given.

LAKEMILL_RETAIL: folder with customers, orders, products and sales sub-folders of CSV files.
LAKEMILL_MISSIONS: folder with one sub-folder per mission, each with a flat CSV file and
most of them with the JSON document it was flattened from.
"""

import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakemill.config import RetailRun
from lakemill.operators import flatten
from lakemill.plans import gold, medallion, missions
from lakemill.schemas import MISSION_COLUMNS
from lakemill.sources import read_documents, read_flat_csv

RETAIL, MISSIONS = os.environ.get("LAKEMILL_RETAIL"), os.environ.get("LAKEMILL_MISSIONS")


@pytest.fixture(scope="module")
def retail(spark, tmp_path_factory):
    if not RETAIL:
        pytest.skip("LAKEMILL_RETAIL is not set")
    root = tmp_path_factory.mktemp("retail")
    names = {layer: f"golden_{layer}" for layer in ("bronze", "silver", "gold")}
    for layer, name in names.items():
        spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}/{layer}'")
    run = RetailRun(landing=RETAIL, run_quality=True, **names)
    medallion.build_layers(spark, run)
    return run


def test_daily_revenue(spark, retail):
    mart = spark.table(retail.table("gold", "daily_revenue"))
    totals = mart.agg(F.count("*"), F.sum("total_revenue"), F.sum("line_count"), F.sum("order_count")).first()
    assert tuple(totals) == (62, Decimal("328233.32"), 100, 67)
    assert [str(v) for v in gold.latest_days(mart, 1).first()] == ["2024-12-27", "7536.57", "2", "1", "1"]


def test_top_products(spark, retail):
    mart = spark.table(retail.table("gold", "top_products"))
    best = gold.ranked_products(mart, 3).select("product_id", "total_qty", "total_sales").collect()
    assert mart.count() == 64
    assert [tuple(r) for r in best] == [
        (32, 14, Decimal("20149.31")), (31, 13, Decimal("19974.95")), (49, 10, Decimal("18961.68")),
    ]


def test_customer_360(spark, retail):
    mart = spark.table(retail.table("gold", "customer_360"))
    assert mart.count() == 100 and mart.agg(F.sum("lifetime_orders")).first()[0] == 100
    assert mart.where("lifetime_orders = 0").count() == 35 and mart.where("lifetime_spend IS NULL").count() == 49
    best = mart.orderBy(F.col("lifetime_spend").desc()).first()
    assert (best.customer_id, best.lifetime_orders, best.lifetime_spend) == (29, 5, Decimal("25350.36"))


def test_all_checks_pass(spark, retail):
    assert spark.table(retail.results_table).where("status <> 'PASS'").count() == 0


@pytest.fixture(scope="module")
def flat(spark):
    if not MISSIONS:
        pytest.skip("LAKEMILL_MISSIONS is not set")
    return read_flat_csv(spark, f"{MISSIONS}/*/*.csv").cache()


def test_documents_flatten_to_their_csv(spark, flat):
    rows_found = flatten.flat_columns(flatten.flatten_documents(read_documents(spark, f"{MISSIONS}/*/*.json")))
    with_document = {p.parent.name for p in Path(MISSIONS).glob("*/*.json")}
    paired = [str(p) for d in with_document for p in (Path(MISSIONS) / d).glob("*.csv")]
    expected = spark.read.csv(paired, header=True, multiLine=True, escape='"').na.fill("")
    assert rows_found.count() == 431
    assert rows(rows_found) == rows(expected.select(*MISSION_COLUMNS))


def test_dashboard(flat):
    people = missions.curated(missions.clean(flat))
    assert tuple(missions.headline_numbers(people).first()) == (837, 508, 138)
    assert tuple(missions.quality_summary(missions.quality_flags(people)).first()) == (0, 0, 4, 0)
    assert [r.role_rows for r in missions.rows_by_role(people).limit(4).collect()] == [531, 197, 13, 11]
    assert [r.investigator_rows for r in missions.rows_by_institution(people).collect()] == [
        208, 105, 27, 27, 20, 19, 16, 14, 12, 12, 12, 11, 10, 10, 9, 8, 8, 8, 7, 7,
    ]
    assert flat.select("mission_identifier").distinct().count() == 20
