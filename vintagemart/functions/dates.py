"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text, blanks around it ignored, to a date; NULL if it is not one."""
    return F.try_to_date(F.trim(text), "yyyy-MM-dd")


def month_number(day: Column) -> Column:
    """A month as one integer, so that neighbouring months differ by one across years."""
    return F.year(day) * 12 + F.month(day)


def first_missed_on(day: Column, missed: Column) -> Column:
    """The snapshot ``missed`` months back, or NULL when nothing was missed.

    ``add_months`` clips to the last day of a shorter month.
    """
    return F.when(missed > 0, F.add_months(day, -missed))
