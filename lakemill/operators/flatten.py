"""Nested mission documents to flat rows, row-local and therefore batch or streaming.

Input is any DataFrame with a JSON text column, one document per row: whole files, a
table of documents, JSON lines.  A document is read level by level: each level gives the text of the values
below it, which never fails and has no size limit of its own, and only the fields that are used
are read further.  So a value of the wrong type is skipped where a typed parse would lose the whole
record, and documents of all sizes take the same way.  Fields that are not listed here, contact
details among them, never leave the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions import empty_if_null, last_url_segment
from lakemill.schemas import MISSION_COLUMNS

DOCUMENT_TYPE = "identifier: string, startDate: string, endDate: string, people: array<string>"
ENTRY_TYPE = "institution string, roles string, person string"
PERSON_TYPE = "firstName string, lastName string"
_LIST_TYPE = "array<string>"
_STRICT = {
    "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str((1 << 31) - 1),
}

# Stands before the content of a JSON string that begins like an object or a list, so that the text of a value
# tells its type: private characters that no document is expected to hold.
_MARK = "\uf8d1lakemill\uf8d1"


_LOOKS_NESTED = r'"(?=\s*(?:[{\[]|\\u007[bB]|\\u005[bB]))'
_NULL_PEOPLE = r'"people"\s*:\s*null\b'


def _marked(text: Column) -> Column:
    """JSON with marked strings; an explicit null as the list of people is made a marked string.

    Few documents have either, and only those are written anew.
    """
    strings = F.regexp_replace(text, _LOOKS_NESTED, f'"{_MARK}')
    marked = F.regexp_replace(strings, _NULL_PEOPLE, f'"people":"{_MARK}null"')
    return F.when(F.rlike(text, F.lit(f"{_LOOKS_NESTED}|{_NULL_PEOPLE}")), marked).otherwise(text)


def _plain(value: Column) -> Column:
    return F.replace(value, F.lit(_MARK), F.lit(""))


def _text(value: Column) -> Column:
    return empty_if_null(_plain(value))


def _is_object(value: Column) -> Column:
    return F.coalesce(F.ltrim(value).startswith("{"), F.lit(False))


def _is_list(value: Column) -> Column:
    return F.coalesce(F.ltrim(value).startswith("["), F.lit(False))


def _list(value: Column) -> Column:
    return F.when(_is_list(value), F.from_json(value, _LIST_TYPE, _STRICT))


def _parsed(docs: DataFrame, text: str) -> DataFrame:
    """Per document the used fields (as text), the reject reason and whether ``people`` is no list.

    The text stands in an array with an object behind it that names the text's hash.  The parser ignores text after
    a complete value; framed this way the document must be exactly one object, or the array does not
    parse or has other elements.
    """
    ids = [c for c in docs.columns if c != text]
    mark = F.xxhash64(text).cast("string")
    whole = F.concat(F.lit("["), _marked(F.col(text)), F.lit(',{"identifier":"'), mark, F.lit('"}]'))
    valid_text = F.is_valid_utf8(text)
    framed = docs.select(
        *ids,
        F.when(F.col(text).isNull(), "no text").when(~valid_text, "not UTF-8").alias("unread"),
        F.when(valid_text, whole).alias("whole"),
        mark.alias("mark"),
    ).withColumn("frame", F.from_json("whole", f"array<struct<{DOCUMENT_TYPE}>>", _STRICT))
    complete = (F.size("frame") == 2) & (F.get("frame", F.lit(1))["identifier"] == F.col("mark"))
    doc = F.when(F.coalesce(complete, F.lit(False)), F.get("frame", F.lit(0)))
    read = framed.select(*ids, "unread", "whole", doc.alias("doc"))
    # looked at once more only where there is no list of people
    one_value = F.coalesce(F.size(F.from_json("whole", _LIST_TYPE, _STRICT)) == 2, F.lit(False))
    as_text = F.get(F.from_json("whole", "array<struct<people: string>>", _STRICT), F.lit(0))["people"]
    not_listed = F.col("doc.people").isNull() & as_text.isNotNull()
    return read.select(
        *ids,
        "doc",
        F.when(F.col("unread").isNotNull(), F.col("unread"))
        .when(F.col("doc").isNotNull(), None)
        .when(one_value, "top level is not an object")
        .otherwise("invalid JSON")
        .alias("reason"),
        F.when(F.col("doc").isNull(), False).otherwise(not_listed).alias("people_not_a_list"),
    )


def _entry(value: Column) -> Column:
    """Fields of an entry of ``people``, NULL when it is no object."""
    return F.when(_is_object(value), F.from_json(value, ENTRY_TYPE, _STRICT))


def _roles(roles: Column) -> Column:
    """Role list: a list as it is, any other value as the only role, nothing as NULL."""
    return F.coalesce(_list(roles), F.when(roles.isNotNull() & ~_is_list(roles), F.array(roles)))


def flatten_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per (document, person, role) with the seven flat columns.

    The other input columns are kept in front, followed by ``person_pos`` and
    ``role_pos``, which give the order within the document.  A person without roles
    has one row with an empty role; entries that are no objects give no row; documents
    that are no JSON objects give none either, see :func:`rejected_documents`.
    """
    ids = [c for c in docs.columns if c != text]
    # the outer forms keep Spark from deriving filters that would parse the text again
    people = _parsed(docs, text).select(
        *ids, "doc", F.posexplode_outer("doc.people").alias("person_pos", "value")
    )
    entries = people.where(_is_object(F.col("value"))).select(
        *ids, "doc", "person_pos", F.from_json("value", ENTRY_TYPE, _STRICT).alias("entry")
    )
    roles = entries.select(
        *ids, "doc", "entry", "person_pos",
        F.posexplode_outer(_roles(F.col("entry.roles"))).alias("role_pos", "role"),
    )
    person = F.col("entry.person")
    named = roles.withColumn("named", F.when(_is_object(person), F.from_json(person, PERSON_TYPE, _STRICT)))
    return named.select(
        *ids,
        "person_pos",
        F.coalesce("role_pos", F.lit(0)).alias("role_pos"),
        _text(F.col("doc.identifier")).alias("mission_identifier"),
        _text(F.col("doc.startDate")).alias("startDate"),
        _text(F.col("doc.endDate")).alias("endDate"),
        _text(F.col("entry.institution")).alias("institution"),
        _text(F.col("role")).alias("role"),
        _text(F.col("named.firstName")).alias("firstName"),
        _text(F.col("named.lastName")).alias("lastName"),
    )


def flat_columns(rows: DataFrame) -> DataFrame:
    """Only the seven flat columns, in file order."""
    return rows.select(*MISSION_COLUMNS)


def in_document_order(rows: DataFrame, *ids: str) -> DataFrame:
    """Sort by document, person and role position."""
    return rows.orderBy(*(ids or ("file_path",)), "person_pos", "role_pos")


def _computed(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows with some columns as a generator's output, below which Spark pushes no filter that would compute them again."""
    others = [c for c in rows.columns if c not in columns]
    return rows.select(*others, F.inline(F.array(F.struct(*columns))))


def rejected_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that give no rows because they are no JSON objects, with the reason."""
    parsed = _parsed(docs, text).drop("doc", "people_not_a_list")
    return _computed(parsed, "reason").where(F.col("reason").isNotNull())


def _row_count(doc: Column) -> Column:
    """Rows a document flattens to, without exploding it."""
    entries = F.filter(doc["people"], _is_object)
    per_entry = F.transform(
        entries, lambda e: F.greatest(F.coalesce(F.size(_roles(_entry(e)["roles"])), F.lit(0)), F.lit(1))
    )
    total = F.aggregate(per_entry, F.lit(0).cast("bigint"), lambda n, rows: n + rows)
    return F.coalesce(total, F.lit(0).cast("bigint"))


def document_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: reject reason, whether ``people`` is there but no list, row count.

    Counted inside each document, so nothing is shuffled; sum ``row_count`` for the total.
    """
    parsed = _computed(_parsed(docs, text), "doc", "reason", "people_not_a_list")
    return parsed.withColumn("row_count", _row_count(F.col("doc"))).drop("doc")


def index_entries(index: DataFrame, first: int | None = None) -> DataFrame:
    """(position, name, url) of the entries of index documents, optionally the first ones.

    The name is the last URL segment.  The limit is by array position, so no sort is needed.
    """
    ids = [c for c in index.columns if c != "data"]
    entries = index.select(*ids, F.posexplode("data").alias("position", "entry"))
    if first is not None:
        entries = entries.where(F.col("position") < first)
    url = F.col("entry.mission")
    return entries.select(*ids, "position", last_url_segment(url).alias("name"), url.alias("url"))
