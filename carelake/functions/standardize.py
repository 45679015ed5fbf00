"""Dates, names, nested fields and other small standardisation expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPACT_DATE = "yyyyMMdd"
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def present(value: Column) -> Column:
    """True where a text value is neither null nor empty."""
    return value.isNotNull() & (value.cast("string") != "")


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def to_date(value: Column, formats: Sequence[str] = ()) -> Column:
    """Date of an 8-digit compact text, an ISO text, or the first matching extra format.

    Text that fits none of them becomes null. Plain ISO text takes the cast,
    which gives the same date without the formatter's work.
    """
    text = value.cast("string")
    plain = F.when((F.length(text) == 10) & text.rlike(ISO_DATE), text.try_cast("date"))
    compact = F.when(F.length(text) == 8, F.try_to_date(text, COMPACT_DATE))
    iso = F.when(F.length(text) != 8, F.try_to_date(text, "yyyy-MM-dd"))
    others = [F.try_to_date(text, f) for f in formats]
    return F.coalesce(plain, compact, iso, *others)


def date_text(value: Column) -> Column:
    """ISO text of a compact date, cut by position; any other text is left as it is."""
    text = value.cast("string")
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(F.length(text) == 8, dashed).otherwise(text)


def full_name(first: Column, last: Column) -> Column:
    """Both names with a blank between; a missing one leaves no stray blank."""
    return F.trim(F.concat_ws(" ", first, last))


def reference_id(reference: Column) -> Column:
    """Last segment of a reference such as ``Patient/P1``."""
    return F.substring_index(reference, "/", -1)


def first_code(coding: Column) -> Column:
    """``code`` of the first entry of a coding array, null if there is none."""
    return F.get(coding, 0)["code"]


def number(value: Column) -> Column:
    """The value as a double; text that is no number becomes null."""
    return value.try_cast("double")


def out_of_range(value: Column, low: Column, high: Column) -> Column:
    """True outside the closed range; false for a missing value, NaN or range."""
    known = F.nanvl(value, F.lit(None).cast("double"))
    return F.coalesce((known < low) | (known > high), F.lit(False))
