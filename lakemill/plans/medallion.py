"""The layers in order; each stage reads the tables of the one before."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakemill.config import RetailRun
from lakemill.plans.bronze import build_bronze
from lakemill.plans.gold import build_gold
from lakemill.plans.quality import run_battery, store_silver_checks
from lakemill.plans.silver import build_silver


def build_layers(spark: SparkSession, run: RetailRun) -> None:
    """Bronze, silver with its stored checks, gold, then the battery if asked for.

    A stage that fails stops the run; the tables of the stages before it stay.
    """
    build_bronze(spark, run)
    build_silver(spark, run)
    store_silver_checks(spark, run)
    build_gold(spark, run)
    if run.run_quality:
        run_battery(spark, run)
