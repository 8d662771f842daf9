"""Calendar expressions.

Conventions: ``dayofweek`` is 1 = Sunday … 7 = Saturday; ``weekofyear`` is the
ISO week; weeks start on Monday; ``date_trunc`` returns a timestamp, so
``period_start`` casts it back to a date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumen.functions.expressions import col_of

# Day-of-week numbers that make a weekend (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = (1, 7)


def date_from_parts(y: str | Column, m: str | Column, d: str | Column) -> Column:
    """``MAKE_DATE(y, m, d)`` that yields NULL (not an ANSI error) for an
    impossible date such as 2013-02-30 or a NULL part."""
    text = F.concat_ws("-", F.lpad(col_of(y).cast("string"), 4, "0"),
                       F.lpad(col_of(m).cast("string"), 2, "0"),
                       F.lpad(col_of(d).cast("string"), 2, "0"))
    ok = col_of(y).isNotNull() & col_of(m).isNotNull() & col_of(d).isNotNull()
    return F.when(ok, F.try_to_date(text, "yyyy-MM-dd"))


def as_date(c: str | Column) -> Column:
    """A timestamp (or timestamp_ntz) column truncated to its calendar date."""
    return F.to_date(col_of(c))


def calendar_columns(d: str | Column) -> dict[str, Column]:
    """The calendar parts of a date column, keyed by output name."""
    d = col_of(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_of_year": F.dayofyear(d),
        "week_of_year": F.weekofyear(d),
        "quarter": F.quarter(d),
    }


def period_start(unit: str, d: str | Column) -> Column:
    """Start date of the period containing ``d`` (unit: week, month, quarter, year)."""
    return F.date_trunc(unit, col_of(d)).cast("date")


def day_type(d: str | Column) -> Column:
    """'Weekend' for Saturday/Sunday, else 'Weekday'."""
    return (F.when(F.dayofweek(col_of(d)).isin(*WEEKEND_DAYS), F.lit("Weekend"))
            .otherwise(F.lit("Weekday")))


def day_name(d: str | Column) -> Column:
    return F.date_format(col_of(d), "EEEE")


def month_name(d: str | Column) -> Column:
    return F.date_format(col_of(d), "MMMM")


def display_date(d: str | Column) -> Column:
    return F.date_format(col_of(d), "MMM dd, yyyy")


def days_until(end: str | Column, start: str | Column) -> Column:
    """``DATEDIFF(end, start)`` in days."""
    return F.datediff(col_of(end), col_of(start))


def year_end(d: str | Column) -> Column:
    """Last day of the calendar year of ``d``."""
    return F.make_date(F.year(col_of(d)), F.lit(12), F.lit(31))
