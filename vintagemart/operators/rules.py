"""Declarative cleaning: a rule table applied as one projection.

A rule names a source column, the column it becomes and the expression that
cleans it.  A whole rule table is a single ``select``, which keeps the plan
flat, needs no shuffle and never drops a row: what cannot be read becomes NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

RAW_PREFIX = "raw_"


@dataclass(frozen=True)
class Rule:
    source: str
    target: str
    clean: Callable[[Column], Column]

    def column(self) -> Column:
        return self.clean(F.col(self.source)).alias(self.target)


def as_is(column: Column) -> Column:
    return column


def apply_rules(df: DataFrame, rules: Iterable[Rule], *, with_raw: bool = False) -> DataFrame:
    """The cleaned columns in rule order.

    ``with_raw`` puts the untouched source, prefixed, behind each cleaned column,
    for the profiles that compare the two.
    """
    columns = []
    for rule in rules:
        columns.append(rule.column())
        if with_raw:
            columns.append(F.col(rule.source).alias(RAW_PREFIX + rule.target))
    return df.select(*columns)
