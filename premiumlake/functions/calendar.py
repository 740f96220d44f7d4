"""Calendar expressions shared by the marts.

Two month encodings coexist on purpose: party marts key on the string ``yyyy-MM`` (it sorts
lexically and is filtered by prefix), customer marts key on the DATE of the month start.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the shape test for raw timestamps
# (M/D/YYYY H:MM:SS, 1- or 2-digit month, day and hour) and the matching parse pattern.
# `\z` instead of `$`: Java's `$` also matches before a trailing newline.
CREATED_AT_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}\z"
CREATED_AT_PATTERN = "M/d/yyyy H:mm:ss"


def parse_created_at(raw: Column) -> Column:
    """Timestamp from the raw string, NULL when the shape is wrong or the date is impossible."""
    return F.when(raw.rlike(CREATED_AT_SHAPE), F.try_to_timestamp(raw, F.lit(CREATED_AT_PATTERN)))


def month_key(d: Column) -> Column:
    """``yyyy-MM`` bucket of a date or timestamp."""
    return F.date_format(d, "yyyy-MM")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_index(d: Column) -> Column:
    """Months since year 0: consecutive months differ by exactly 1."""
    return F.year(d) * 12 + F.month(d)


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def days_left_in_month(d: Column) -> Column:
    """Days from ``d`` to the end of its month, both ends included."""
    return F.datediff(F.last_day(d), d) + 1


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months from ``earlier`` to ``later`` (PostgreSQL ``age`` years*12 + months on
    month starts)."""
    return month_index(later) - month_index(earlier)
