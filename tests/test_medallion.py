"""All layers on a handful of rows with known results, and on re-ingested files."""

from decimal import Decimal

import pytest

from conftest import rows
from lakemill.config import RetailRun
from lakemill.plans import medallion, quality
from lakemill.schemas import RETAIL_COLUMNS

EXPORTS = {
    "customers": "1,Ada,One,u1@example.com,2023-01-05,UK\n2,Bo,Two,u2@example.com,2024-02-06,Canada",
    "products": "10,P_010,Audio,20.00,True\n11,P_011,Office,5.50,False",
    "orders": "100,1,2024-03-01,PAID\n101,1,2024-03-01,CANCELLED\n102,2,2024-03-02,NEW",
    "sales": "900,100,10,2,20.00,0.10,36.00\n901,101,11,1,5.50,0.0,5.50\n902,100,99,1,7.00,0.0,7.00",
}


@pytest.fixture
def run(spark, schema, tmp_path):
    for name, lines in EXPORTS.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.csv").write_text(",".join(RETAIL_COLUMNS[name]) + "\n" + lines + "\n")

    def build(**options):
        names = {layer: f"{schema}_{layer}" for layer in ("bronze", "silver", "gold")}
        for layer, name in names.items():
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{tmp_path}/{layer}'")
        return RetailRun(landing=str(tmp_path), **names, **options)

    yield build
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema}_{layer} CASCADE")


def gold(spark, run, name):
    return rows(spark.table(run.table("gold", name)))


@pytest.mark.parametrize("infer", [False, True])
def test_marts(spark, run, infer):
    run = run(infer_schema=infer, run_quality=True)
    medallion.build_layers(spark, run)
    assert [(str(d), *rest) for d, *rest in gold(spark, run, "daily_revenue")] == [
        ("2024-03-01", Decimal("48.50"), 3, 2, 1),
    ]
    assert gold(spark, run, "top_products") == [
        (10, "P_010", "Audio", 2, Decimal("36.00")),
        (11, "P_011", "Office", 1, Decimal("5.50")),
        (99, None, None, 1, Decimal("7.00")),
    ]
    assert gold(spark, run, "customer_360") == [
        (1, "Ada", "One", "u1@example.com", "UK", 2, Decimal("48.50")),
        (2, "Bo", "Two", "u2@example.com", "Canada", 1, None),
    ]
    types = dict(spark.table(run.table("silver", "sales")).dtypes)
    assert (types["sale_id"], types["unit_price"], types["discount_pct"]) == ("bigint", "decimal(18,2)", "decimal(5,2)")
    failed = quality.latest_results(spark.table(run.results_table)).where("status = 'FAIL'").collect()
    assert [(r.check_name, r.bad_count) for r in failed] == [("orphan_sales_products", 1)]
    assert spark.table(run.results_table).count() == 3 + 19


@pytest.mark.parametrize(
    "options, revenue",
    [({}, "97.00"), ({"dedupe_sales": True}, "48.50"), ({"bronze_mode": "overwrite"}, "48.50")],
)
def test_second_ingest_of_the_same_files(spark, run, options, revenue):
    run = run(**options)
    for _ in range(2):
        medallion.build_layers(spark, run)
    assert gold(spark, run, "daily_revenue")[0][1] == Decimal(revenue)
    assert spark.table(run.table("silver", "orders")).count() == 3


def test_a_failed_stage_stops_the_run(spark, run, tmp_path):
    run = run()
    (tmp_path / "sales" / "sales.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        medallion.build_layers(spark, run)
    assert not spark.catalog.tableExists(run.table("silver", "customers"))


def test_marts_share_the_sums_per_order(spark, run, monkeypatch):
    from lakemill.plans import gold as marts

    made, kept = [], spark.sparkContext._jsc.getPersistentRDDs().size()
    plain = marts.order_totals
    monkeypatch.setattr(marts, "order_totals", lambda sales: made.append(sales) or plain(sales))
    run = run()
    medallion.build_layers(spark, run)
    assert len(made) == 1 and gold(spark, run, "daily_revenue")[0][1:] == (Decimal("48.50"), 3, 2, 1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_run_parameters():
    assert RetailRun("l", catalog="c").table("gold", "m") == "c.gold.m"
    with pytest.raises(ValueError):
        RetailRun("l", bronze_mode="merge")
