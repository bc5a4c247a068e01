from datetime import date

import pytest

from conftest import rows
from lakemill.config import MissionRun
from lakemill.plans import missions
from lakemill.schemas import MISSION_SCHEMA
from lakemill.sinks import write_flat_parquet

PEOPLE = [
    ("M-1", "01/02/1992", "01/09/1992", "Lab", "PI", "Ada", "One"),
    ("M-1", "01/02/1992", "01/09/1992", "Lab", "CI", "Bo", "Two"),
    ("M-2", "02/30/1992", "", None, None, "Ada", "One"),
    ("M-2", "1992-01-01", None, "", "", "", ""),
    ("", None, None, "Other", "CI", None, "Three"),
    (None, None, None, "Other", "CI", None, None),
]


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame(PEOPLE, MISSION_SCHEMA)


@pytest.fixture(scope="module")
def people(flat):
    return missions.curated(missions.clean(flat))


def test_clean(flat):
    cleaned = {(r.mission_identifier, r.role): r for r in missions.clean(flat).collect()}
    first = cleaned["M-1", "PI"]
    assert (first.start_date, first.end_date, first.full_name) == (date(1992, 1, 2), date(1992, 1, 9), "Ada One")
    assert [r.start_date for r in missions.clean(flat).where("mission_identifier = 'M-2'").collect()] == [None, None]
    assert not missions.clean(flat).where("role IS NULL OR institution IS NULL").count()


def test_names_of_blanks_only_count_as_present_unless_trimmed(flat):
    missing = lambda trim: missions.quality_summary(
        missions.quality_flags(missions.curated(missions.clean(flat, trim)))
    ).first().missing_person_name
    assert (missing(False), missing(True)) == (1, 2)


def test_views_of_the_same_rows(people):
    assert people.columns == list(missions.CURATED_COLUMNS)
    flags = missions.quality_flags(people)
    assert flags.columns == [*missions.CURATED_COLUMNS, *(f"is_missing_{n}" for n in missions.QUALITY_FLAGS)]
    assert tuple(missions.quality_summary(flags).first()) == (2, 1, 2, 2)
    assert tuple(missions.quality_summary(flags.limit(0)).first()) == (None,) * 4


def test_counts(people):
    assert [tuple(r) for r in missions.rows_by_institution(people).collect()] == [("", 2), ("Lab", 2), ("Other", 2)]
    assert missions.rows_by_institution(people, 1).collect()[0].institution == ""
    assert [tuple(r) for r in missions.rows_by_role(people).collect()] == [("CI", 3), ("", 2), ("PI", 1)]
    assert tuple(missions.headline_numbers(people).first()) == (6, 3, 3)
    assert tuple(missions.headline_numbers(people.limit(0)).first()) == (0, 0, 0)


def test_preview(people):
    names = [r.full_name for r in missions.preview(people, 3).collect()]
    assert names == ["", "Three", "Bo Two"]


def test_run_parameters():
    run = MissionRun(" in ", "/root/ ", table="people", mode=" Append ")
    assert (run.parquet_path, run.storage_path, run.full_table, run.mode) == ("in", "/root/people", "missions.people", "append")
    assert MissionRun("i", "r", catalog="c", schema="s", table="t").quality_view == "c.s.vw_t_quality"
    with pytest.raises(ValueError):
        MissionRun("i", "r", mode="merge")


def test_load_overwrite_and_append(spark, schema, flat, tmp_path):
    write_flat_parquet(flat, f"{tmp_path}/flat")
    overwrite = MissionRun(f"{tmp_path}/flat", f"{tmp_path}/external", schema=schema, table="people")
    append = MissionRun(f"{tmp_path}/flat", f"{tmp_path}/external", schema=schema, table="people", mode="append")
    missions.load_missions(spark, overwrite)
    missions.load_missions(spark, append)
    assert spark.table(overwrite.full_table).count() == 12
    missions.load_missions(spark, overwrite)
    assert rows(spark.table(overwrite.quality_view)) == rows(missions.quality_flags(missions.curated(missions.clean(flat))))
    assert spark.table(overwrite.curated_view).columns == list(missions.CURATED_COLUMNS)
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {overwrite.full_table}").collect()}
    assert details["Type"] == "EXTERNAL" and details["Comment"].startswith("Flat mission")


def test_cluster_keeps_rows_and_views(spark, schema, flat, tmp_path):
    table = f"{schema}.people"
    many = flat.unionByName(flat.where("mission_identifier = 'M-1'").crossJoin(spark.range(200)).drop("id"))
    many.repartition(4).write.saveAsTable(table)
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT institution FROM {table}")
    before = rows(spark.table(table))
    missions.cluster_missions(spark, table, 4)
    assert rows(spark.table(table)) == before
    assert spark.table(f"{schema}.v").count() == len(before)
    per_file = spark.table(table).groupBy("_metadata.file_path").count().collect()
    # the value that holds nearly all rows is spread over the files
    assert len(per_file) == 4 and max(r["count"] for r in per_file) < len(before) / 2
    assert not [t.name for t in spark.catalog.listTables(schema) if "clustering" in t.name]
