"""Casts, masks and slice labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import MONEY


def number(text: Column, to: str = "double") -> Column:
    """Text as a number, null where it is malformed, also in ANSI mode."""
    return text.try_cast(to)


def money(text: Column) -> Column:
    """Text as an exact amount with two digits, rounded half up."""
    return text.try_cast(MONEY)


def masked(column: Column, method: str = "sha2", salt: str | None = None) -> Column:
    """Personal text made unreadable.

    ``sha2`` keeps null as null and may be salted. ``murmur3`` gives the 32-bit hash as text
    and turns null into ``'42'``. ``null`` blanks the value.
    """
    if method == "sha2":
        return F.sha2(column if salt is None else F.concat(F.lit(salt), column), 256)
    if method == "murmur3":
        return F.hash(column).cast("string")
    if method == "null":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown mask {method!r}")


def slice_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def slice_hour(ts: Column, pinned: str | None = None) -> Column:
    return F.lit(pinned) if pinned is not None else F.date_format(ts, "HH")


def month_name(date: Column) -> Column:
    """English month name of a date or its text."""
    return F.date_format(date.cast("date"), "MMMM")
