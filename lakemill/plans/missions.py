"""Flat mission rows: cleaning, views and dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.config import MissionRun
from lakemill.functions import conditional_sum, empty_if_null, full_name, is_missing, us_date
from lakemill.operators.flatten import document_report, flatten_documents
from lakemill.operators.topk import counted, largest, top
from lakemill.sinks import (
    comment_on,
    create_schema,
    register_external,
    write_flat_csv,
    write_flat_parquet,
    write_path,
    zorder_table,
)
from lakemill.sources import read_documents, read_parquet

# Columns of the curated view, and the fields each quality flag looks at.
CURATED_COLUMNS = (
    "mission_identifier", "startDate", "endDate", "start_date", "end_date",
    "institution", "role", "firstName", "lastName", "full_name",
)
QUALITY_FLAGS = {
    "mission_identifier": "mission_identifier",
    "person_name": "full_name",
    "institution": "institution",
    "role": "role",
}
PREVIEW_COLUMNS = ("mission_identifier", "startDate", "endDate", "institution", "role", "full_name")
PREVIEW_ORDER = ("mission_identifier", "institution", "role", "full_name")


def clean(rows: DataFrame, trim_names: bool = False) -> DataFrame:
    """Add parsed dates and the full name; no NULL role or institution."""
    return rows.withColumns({
        "start_date": us_date("startDate"),
        "end_date": us_date("endDate"),
        "full_name": full_name("firstName", "lastName", trim_names),
        "role": empty_if_null("role"),
        "institution": empty_if_null("institution"),
    })


def curated(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*CURATED_COLUMNS)


def quality_flags(people: DataFrame) -> DataFrame:
    """All columns plus four flags for missing values."""
    flags = (is_missing(column).alias(f"is_missing_{name}") for name, column in QUALITY_FLAGS.items())
    return people.select("*", *flags)


def rows_by_institution(people: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` institutions with most rows, equal ones by name."""
    return largest(counted(people, "institution", "investigator_rows"), "investigator_rows", ["institution"], k)


def rows_by_role(people: DataFrame) -> DataFrame:
    return largest(counted(people, "role", "role_rows"), "role_rows", ["role"])


def headline_numbers(people: DataFrame) -> DataFrame:
    """Rows, distinct people and distinct institutions, as one row.

    A person with a NULL name part is no distinct person; the empty institution is one
    institution.
    """
    person = F.concat("firstName", F.lit(" "), "lastName")
    return people.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct(person).alias("distinct_people"),
        F.countDistinct("institution").alias("distinct_institutions"),
    )


def quality_summary(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        *(conditional_sum(F.col(f"is_missing_{name}")).alias(f"missing_{name}") for name in QUALITY_FLAGS)
    )


def preview(people: DataFrame, k: int = 50) -> DataFrame:
    """First ``k`` rows by mission, institution, role and name; dates break ties."""
    return top(people.select(*PREVIEW_COLUMNS), k, *PREVIEW_ORDER, "startDate", "endDate")


def flatten_files(
    spark: SparkSession, source: str, csv: str | None = None, parquet: str | None = None
) -> DataFrame:
    """Flatten document files into CSV and Parquet folders; returns the report per document.

    Documents that cannot be read are in the report with a reason and stop nothing.  The CSV is made from the
    Parquet files where both are wanted, so the documents are flattened once.
    """
    documents = read_documents(spark, source)
    rows = flatten_documents(documents)
    if parquet:
        write_flat_parquet(rows, parquet)
        rows = read_parquet(spark, parquet)
    if csv:
        write_flat_csv(rows, csv)
    return document_report(documents)


def create_views(spark: SparkSession, run: MissionRun) -> None:
    """The curated view over the table and the quality view over the curated one."""
    columns = ", ".join(CURATED_COLUMNS)
    spark.sql(f"CREATE OR REPLACE VIEW {run.curated_view} AS SELECT {columns} FROM {run.full_table}")
    flags = ", ".join(
        f"coalesce({column}, '') = '' AS is_missing_{name}" for name, column in QUALITY_FLAGS.items()
    )
    spark.sql(f"CREATE OR REPLACE VIEW {run.quality_view} AS SELECT *, {flags} FROM {run.curated_view}")


def load_missions(spark: SparkSession, run: MissionRun) -> None:
    """Clean flat rows from Parquet into an external table with its views."""
    rows = clean(read_parquet(spark, run.parquet_path), run.trim_names)
    write_path(rows, run.storage_path, run.mode, run.table_format)
    create_schema(spark, run.full_schema)
    register_external(
        spark, run.full_table, run.storage_path, run.table_format, replace=run.mode == "overwrite"
    )
    comment_on(spark, run.full_table, "Flat mission, person and role rows for analytics.")
    create_views(spark, run)


def cluster_missions(spark: SparkSession, table: str, partitions: int | None = None) -> None:
    """Cluster a table of mission rows by mission and institution at once."""
    zorder_table(spark, table, ("mission_identifier", "institution"), partitions)
