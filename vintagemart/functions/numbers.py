"""Parsing, bounding and combining numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, IntegerType


def parse_number(text: Column) -> Column:
    """Dirty numeric text to double.

    Blanks around the value and underscores after it are removed.  What is left
    of a lone ``_`` is empty and what is left of ``__10000__`` still starts with
    underscores; neither is a number, so both sentinels become NULL by the cast.
    """
    return F.rtrim(F.trim(text), F.lit("_")).try_cast("double")


def parse_whole(text: Column) -> Column:
    """Dirty numeric text to int, through double so that ``3.0`` is read as 3."""
    return parse_number(text).try_cast("int")


def typed(value: Column, kind: DataType) -> Column:
    """A value in a declared type, NULL if it does not fit; ``6.0`` is read as the whole number 6."""
    if isinstance(kind, IntegerType):
        value = value.try_cast("double")
    return value.try_cast(kind)


def only_if(holds: Column, message: str, value: Column) -> Column:
    """The value where the condition holds; the query fails with the message where it does not.

    This enforces an invariant inside a plan that computes its evidence anyway.
    """
    return F.when(holds, value).otherwise(F.raise_error(F.lit(message)))


def strict_int(text: Column) -> Column:
    """Whole-number text to int; ``3.0`` and any other text become NULL."""
    return F.trim(text).try_cast("int")


def ceil_int(numerator: Column, denominator: Column) -> Column:
    """Ratio rounded up to an int; NULL when the denominator is NULL or zero."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.ceil(ratio).try_cast("int")


def keep_between(value: Column, low: float, high: float) -> Column:
    """The value inside the closed range, NULL outside it."""
    return F.when(value.between(low, high), value)


def keep_at_most(value: Column, cap: float) -> Column:
    """The value up to the cap (negatives included), NULL above it."""
    return F.when(value <= cap, value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient over a positive denominator; NULL if either side is missing."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def flag_below(value: Column, threshold: float) -> Column:
    """1 below the threshold, 0 from it on, NULL for an unknown value."""
    return (value < threshold).cast("int")


def yes_no_flag(value: Column) -> Column:
    """``Yes`` as 1, ``No`` as 0, anything else as NULL."""
    return F.when(value.isin("Yes", "No"), (value == "Yes").cast("int"))
