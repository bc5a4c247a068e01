"""Every branch of the document flattener, batch and streaming."""

import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from lakemill.operators import flatten
from lakemill.schemas import MISSION_COLUMNS
from lakemill.plans.missions import flatten_files
from lakemill.sources import read_documents, read_flat_csv, read_index
from lakemill.streaming import arriving_documents, drain_into


def person(**fields):
    return {"institution": "I", "person": {"firstName": "F", "lastName": "L", "phone": "555", "emailAddress": "a@b.c"}, **fields}


def mission(*people, **fields):
    return json.dumps({"identifier": "M", "startDate": "01/02/1992", "endDate": "01/09/1992", "people": list(people), **fields})


ONE = ("I", "PI", "F", "L")
CASES = {
    "one person": (mission(person(roles=["PI"])), [ONE]),
    "two roles": (mission(person(roles=["PI", "CI"])), [ONE, ("I", "CI", "F", "L")]),
    "no roles": (mission(person(roles=[])), [("I", "", "F", "L")]),
    "null roles": (mission(person(roles=None)), [("I", "", "F", "L")]),
    "missing roles": (mission(person()), [("I", "", "F", "L")]),
    "role is text": (mission(person(roles="PI")), [ONE]),
    "role is a number": (mission(person(roles=7)), [("I", "7", "F", "L")]),
    "null role": (mission(person(roles=["PI", None])), [ONE, ("I", "", "F", "L")]),
    "null institution": (mission(person(roles=["PI"], institution=None)), [("", "PI", "F", "L")]),
    "no institution": (mission({"roles": ["PI"], "person": {"firstName": "F"}}), [("", "PI", "F", "")]),
    "person is text": (mission(person(roles=["PI"], person="F L")), [("I", "PI", "", "")]),
    "person is null": (mission(person(roles=["PI"], person=None)), [("I", "PI", "", "")]),
    "stray entries": (mission(7, "x", None, [1], person(roles=["PI"]), True), [ONE]),
    "numeric name": (mission(person(roles=["PI"], person={"firstName": 5, "lastName": None})), [("I", "PI", "5", "")]),
    "people is an object": (mission(people={"a": 1}), []),
    "people is null": (mission(people=None), []),
    "people is text": (mission(people="x"), []),
    "people is missing": ('{"identifier": "M"}', []),
    "no people": (mission(), []),
    "line breaks and quotes": (mission(person(roles=['P"I\n2'])), [("I", 'P"I\n2', "F", "L")]),
    "repeated key": ('{"identifier": "M", "people": [], "people": [{"roles": "PI", "institution": "I"}]}', [("I", "PI", "", "")]),
    "escapes": ('{"people": [{"roles": "\\u00e9\\ud83d\\ude00", "institution": ""}]}', [("", "é😀", "", "")]),
    "blank around": ("\n  " + mission(person(roles=["PI"])) + " \n", [ONE]),
}
REJECTS = {
    "broken": ("{oops", "invalid JSON"),
    "empty": ("", "invalid JSON"),
    "blank": ("  \n", "invalid JSON"),
    "text after the document": (mission(person(roles=["PI"])) + " x", "invalid JSON"),
    "two documents": ("{}\n{}", "invalid JSON"),
    "two documents with comma": ("{}, {}", "invalid JSON"),
    "closing bracket": ("{}] x", "invalid JSON"),
    "only a bracket": ("{}]", "invalid JSON"),
    "single quotes": ("{'people': []}", "invalid JSON"),
    "control character": ('{"identifier": "a\tb"}', "invalid JSON"),
    "byte order mark": ("﻿{}", "invalid JSON"),
    "list": ("[1, 2]", "top level is not an object"),
    "list of documents": ("[" + mission(person(roles=["PI"])) + "]", "top level is not an object"),
    "number": ("7", "top level is not an object"),
    "null": ("null", "top level is not an object"),
    "missing": (None, "no text"),
}
NOT_LISTS = {"people is an object", "people is text", "people is null"}


@pytest.fixture(scope="module")
def docs(spark):
    texts = {name: text for name, (text, _) in (CASES | REJECTS).items()}
    return spark.createDataFrame(list(texts.items()), "name string, text string").repartition(3)


def test_rows(docs):
    flat = flatten.in_document_order(flatten.flatten_documents(docs), "name").collect()
    found = {}
    for r in flat:
        found.setdefault(r.name, []).append((r.institution, r.role, r.firstName, r.lastName))
    assert found == {name: expected for name, (_, expected) in CASES.items() if expected}


def test_columns_and_positions(docs):
    flat = flatten.flatten_documents(docs)
    assert flat.columns == ["name", "person_pos", "role_pos", *MISSION_COLUMNS]
    stray = flat.where("name = 'stray entries'").first()
    assert (stray.person_pos, stray.role_pos) == (4, 0)
    assert stray.mission_identifier == "M" and stray.startDate == "01/02/1992" and stray.endDate == "01/09/1992"
    assert not [r for r in flat.collect() if "555" in str(r) or "a@b.c" in str(r)]


def test_rejects(docs):
    assert dict(flatten.rejected_documents(docs).collect()) == {n: reason for n, (_, reason) in REJECTS.items()}


def test_invalid_utf8_is_rejected(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"identifier": "\xff\xfe"}')
    docs = read_documents(spark, str(tmp_path))
    assert [r.reason for r in flatten.rejected_documents(docs).collect()] == ["not UTF-8"]
    assert flatten.flatten_documents(docs).count() == 0


def test_report_counts_the_rows_of_every_document(docs):
    report = {r.name: r for r in flatten.document_report(docs).collect()}
    assert {n: r.row_count for n, r in report.items()} == {
        **{n: len(expected) for n, (_, expected) in CASES.items()}, **dict.fromkeys(REJECTS, 0),
    }
    assert {n for n, r in report.items() if r.people_not_a_list} == NOT_LISTS
    assert {n for n, r in report.items() if r.reason} == set(REJECTS)


def test_strings_that_look_like_objects_stay_strings(spark):
    inner = json.dumps(person(roles=["PI"]))
    texts = {
        "entry": mission(inner, "{}", " {} ", "[1]", person(roles=["PI"])),
        "escaped": '{"people": ["\\u007b}", {"roles": "PI"}]}',
        "people": json.dumps({"people": f"[{inner}]"}),
        "role": mission(person(roles='["x"]'), person(roles=["{a}", "[b", 'a \\"{c}'])),
        "values": mission({"institution": "{I}", "roles": "PI", "person": {"firstName": "[F]", "lastName": "{"}}),
        "person": mission(person(roles=["PI"], person='{"firstName": "x"}')),
    }
    docs = spark.createDataFrame(list(texts.items()), "name string, text string")
    found = {}
    for r in flatten.in_document_order(flatten.flatten_documents(docs), "name").collect():
        found.setdefault(r.name, []).append((r.institution, r.role, r.firstName, r.lastName))
    assert found == {
        "entry": [ONE],
        "escaped": [("", "PI", "", "")],
        "role": [("I", '["x"]', "F", "L"), ("I", "{a}", "F", "L"), ("I", "[b", "F", "L"), ("I", 'a \\"{c}', "F", "L")],
        "values": [("{I}", "PI", "[F]", "{")],
        "person": [("I", "PI", "", "")],
    }
    report = {r.name: (r.reason, r.people_not_a_list, r.row_count) for r in flatten.document_report(docs).collect()}
    assert report["people"] == (None, True, 0) and report["entry"] == (None, False, 1)


def test_documents_of_any_size_are_read_alike(spark, tmp_path):
    """Beyond 128 MiB, in an unread field and in one that is read."""
    long = F.repeat(F.lit("0123456789abcdef"), (F.col("id") + (9 << 20)).cast("int"))
    piece = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    docs = spark.range(1).select(
        F.explode(F.array(
            F.struct(F.lit("object").alias("name"), piece('{"people": {"a": "', long, '"}}').alias("text")),
            F.struct(
                F.lit("unread").alias("name"),
                piece('{"people": [{"roles": ["PI", "CI"], "note": "', long, '"}, {"roles": "PI"}]}').alias("text"),
            ),
            F.struct(
                F.lit("read").alias("name"), piece('{"people": [{"institution": "', long, '"}, 7]}').alias("text")
            ),
        )).alias("d")
    ).select("d.*")
    docs.write.partitionBy("name").parquet(f"{tmp_path}/docs")
    expected = {
        "object": (True, []),
        "unread": (False, [("CI", 0), ("PI", 0), ("PI", 0)]),
        "read": (False, [("", 9 << 24)]),
    }
    for name, (flag, people) in expected.items():
        one = spark.read.parquet(f"{tmp_path}/docs/name={name}")
        assert rows(flatten.document_report(one)) == [(None, flag, len(people))]
        assert rows(flatten.flatten_documents(one).select("role", F.length("institution"))) == people


def test_each_level_is_parsed_once_and_nothing_is_shuffled(spark, tmp_path):
    spark.createDataFrame([("a", "{}")], "name string, text string").write.parquet(f"{tmp_path}/docs")
    plan = plan_of(flatten.flatten_documents(spark.read.parquet(f"{tmp_path}/docs")))
    assert "Exchange" not in plan and "Python" not in plan
    # the document, an entry, its roles, its person
    assert plan.count("from_json(") == 4, plan


def test_files_directory_pattern_and_single(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("b.json", "a 1%20+.json", "skip.txt", "deep/c.json"):
        (tmp_path / name).write_text(json.dumps(json.loads(mission(person(roles=["PI"]))), indent=2))
    names = lambda path: sorted(p.rsplit("/", 1)[-1] for (p,) in read_documents(spark, path).select("file_path").collect())
    assert names(str(tmp_path)) == ["a 1%20+.json", "b.json"]
    assert names(f"{tmp_path}/*/*.json") == ["c.json"]
    assert names(f"{tmp_path}/?.json") == ["b.json"]
    assert names(f"{tmp_path}/[ab].json") == ["b.json"]
    assert names(f"{tmp_path}/skip.txt") == ["skip.txt"]


def test_directory_with_wildcard_characters_in_its_name(spark, tmp_path):
    folder = tmp_path / "x[1]{a}"
    folder.mkdir()
    (folder / "a.json").write_text("{}")
    assert read_documents(spark, str(folder)).count() == 1


def test_no_documents_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("{}")
    with pytest.raises(FileNotFoundError):
        read_documents(spark, str(tmp_path))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_documents(spark, f"{tmp_path}/none.json")


def test_streamed_documents_flatten_like_a_batch(spark, schema, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, (text, _) in enumerate((CASES | REJECTS).values()):
        if text is not None:
            (landing / f"{i}.json").write_text(text)
    stream = flatten.flatten_documents(arriving_documents(spark, str(landing)))
    drain_into(stream, f"{schema}.flat", str(tmp_path / "ledger"))
    batch = flatten.flatten_documents(read_documents(spark, str(landing))).drop("file_path")
    assert rows(spark.table(f"{schema}.flat")) == rows(batch)


def test_flatten_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for name in ("two roles", "no people"):
        (landing / f"{name}.json").write_text(CASES[name][0])
    (landing / "broken.json").write_text(REJECTS["broken"][0])
    report = flatten_files(spark, str(landing), f"{tmp_path}/csv", f"{tmp_path}/parquet")
    found = {r.file_path.rsplit("/", 1)[-1]: (r.reason, r.row_count) for r in report.collect()}
    assert found == {"two roles.json": (None, 2), "no people.json": (None, 0), "broken.json": ("invalid JSON", 0)}
    expected = [("M", "01/02/1992", "01/09/1992", "I", role, "F", "L") for role in ("CI", "PI")]
    assert rows(read_flat_csv(spark, f"{tmp_path}/csv")) == expected
    assert rows(spark.read.parquet(f"{tmp_path}/parquet")) == expected


def test_index(spark, tmp_path):
    urls = [f"https://example.com/api/{n}" for n in ("A-1", "B%20II", "C", "D")]
    (tmp_path / "index.json").write_text(json.dumps({"data": [{"mission": u} for u in urls]}, indent=2))
    index = read_index(spark, str(tmp_path / "index.json"))
    assert [tuple(r) for r in flatten.index_entries(index).orderBy("position").collect()] == [
        (0, "A-1", urls[0]), (1, "B%20II", urls[1]), (2, "C", urls[2]), (3, "D", urls[3]),
    ]
    assert rows(flatten.index_entries(index, first=2).select("name")) == [("A-1",), ("B%20II",)]


def test_no_filter_parses_the_text_again(spark):
    docs = spark.createDataFrame([("a", "[]"), ("b", "{}")], "doc_id string, text string")
    plan = flatten.rejected_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")]
    assert filters and all(re.fullmatch(r"[ +:-]*Filter isnotnull\(reason#\d+\)", line) for line in filters)
