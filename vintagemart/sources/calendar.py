"""Months: the spine a backfill runs over, and slices of a table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import to_day

# Fixed value: months in a trailing window, the current one included.
TRAILING_MONTHS = 3


def parse_day(day: str | date) -> date:
    """A ``yyyy-MM-dd`` text as a date; any other text is an error."""
    if isinstance(day, date):
        return day
    return datetime.strptime(day, "%Y-%m-%d").date()


def _shift(day: date, months: int) -> date:
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def months_between(start: str | date, end: str | date) -> list[date]:
    """First of every month from the start's month to the end, both included."""
    first, last = parse_day(start).replace(day=1), parse_day(end)
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    return [_shift(first, i) for i in range(count)]


def trailing_months(day: str | date, months: int = TRAILING_MONTHS) -> list[date]:
    """The given month and the ones before it, oldest first."""
    return [_shift(parse_day(day), -back) for back in reversed(range(months))]


def month_spine(start: Column, end: Column) -> Column:
    """The same months as rows, from two date columns; use in a ``select``."""
    return F.explode(F.sequence(F.trunc(start, "MM").cast("date"), end, F.expr("interval 1 month")))


def spine_of(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """All months between the first and the last snapshot of a table."""
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return bounds.select(month_spine(F.col("first"), F.col("last")).alias("snapshot_date"))


def slice_months(df: DataFrame, months: Iterable[str | date], column: str = "snapshot_date") -> DataFrame:
    """Rows of the given months.

    Text is read as a date, blanks around it ignored.  The months are literals, so
    the filter prunes partitions or, on a date column, reaches the reader.
    """
    return df.filter(day_of(df, column).isin([parse_day(m) for m in months]))


def day_of(df: DataFrame, column: str = "snapshot_date") -> Column:
    """A column of dates, or of text, as a date."""
    is_text = isinstance(df.schema[column].dataType, StringType)
    return to_day(F.col(column)) if is_text else F.col(column)
