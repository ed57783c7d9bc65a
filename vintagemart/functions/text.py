"""Cleaning and reading text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings that mean "no value", compared in lower case.
MISSING_WORDS = ("", "unknown", "n/a", "na", "nan", "null", "none")

# How a loan list and a credit history are spelled.
LAST_ITEM_JOINER = r",\s*and\s+"
ITEM_SEPARATOR = r",\s*"
DURATION = r"^\s*(\d+)\s+Years?\s+and\s+(\d+)\s+Months?\s*$"


def normal_key(text: Column) -> Column:
    """An entity key without surrounding blanks."""
    return F.trim(text)


def clear_tokens(text: Column, *tokens: str) -> Column:
    """The trimmed text, or NULL when all of it is one of the placeholder tokens."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(*tokens), trimmed)


def is_missing_text(value: Column) -> Column:
    """True for NULL and for the spellings of "no value"; never NULL itself."""
    return value.isNull() | F.lower(F.trim(value.cast("string"))).isin(*MISSING_WORDS)


def list_length(text: Column) -> Column:
    """Number of items in ``A, B, and C`` text: 0 for NULL, 1 for an empty text."""
    items = F.split(F.regexp_replace(text, LAST_ITEM_JOINER, ", "), ITEM_SEPARATOR)
    return F.when(text.isNull(), 0).otherwise(F.size(items))


def months_of_duration(text: Column) -> Column:
    """``16 Years and 2 Months`` to 194.

    Text of any other form extracts as empty, which casts to NULL; so does a
    duration too long for an int.
    """
    years = F.regexp_extract(text, DURATION, 1).try_cast("int")
    months = F.regexp_extract(text, DURATION, 2).try_cast("int")
    return F.try_add(F.try_multiply(years, F.lit(12)), months)
