"""Column expressions; all are built-in functions and stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace columns by their casts; a value that does not fit becomes NULL.

    ``try_cast`` because a malformed field must reach the quality checks as NULL
    and not fail the job under ANSI mode.
    """
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def us_date(text: Column | str) -> Column:
    """Date from ``MM/dd/yyyy`` text, NULL when it does not parse."""
    return F.try_to_date(text, "MM/dd/yyyy")


def empty_if_null(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def full_name(first: str, last: str, trim: bool = False) -> Column:
    """Both names with one blank between; NULL parts are skipped, empty ones are not.

    Two empty names thus give one blank, which no missing-name test catches;
    ``trim`` removes it.
    """
    name = F.concat_ws(" ", F.col(first), F.col(last))
    return F.trim(name) if trim else name


def is_missing(column: Column | str) -> Column:
    """True for NULL and empty text, never NULL."""
    return empty_if_null(column) == ""


def last_url_segment(url: Column | str, decode: bool = False) -> Column:
    """Text after the last slash without quotes; percent escapes stay unless decoded."""
    name = F.translate(F.substring_index(url, "/", -1), '"', "")
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))) if decode else name


def line_total_error() -> Column:
    """Absolute gap between the stored and the recomputed line total (exact decimals)."""
    expected = F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount_pct"))
    return F.abs(F.col("line_total") - expected)


def conditional_sum(condition: Column) -> Column:
    """Rows where the condition holds; NULL counts as no, and no rows at all give NULL."""
    return F.sum(F.when(condition, 1).otherwise(0))


def pass_or_fail(bad_count: Column) -> Column:
    return F.when(bad_count == 0, "PASS").otherwise("FAIL")
