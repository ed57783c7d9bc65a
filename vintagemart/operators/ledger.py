"""Silver loan ledger: typing, instalments missed and days past due."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, NumericType

from ..functions import ceil_int, first_missed_on, typed
from ..schemas import LEDGER


def enforce_types(df: DataFrame) -> DataFrame:
    """The ledger columns in their declared types; unreadable values become NULL."""
    return df.select(*[typed(F.col(f.name), f.dataType).alias(f.name) for f in LEDGER])


def with_missed_installments(df: DataFrame) -> DataFrame:
    """Month on book, and arrears counted in instalments rounded up (NULL if not defined)."""
    return df.select(
        "*",
        typed(F.col("installment_num"), IntegerType()).alias("mob"),
        ceil_int(F.col("overdue_amt"), F.col("due_amt")).alias("installments_missed"),
    )


def zero_fill(df: DataFrame) -> DataFrame:
    """Every numeric column of the frame with 0 in place of NULL."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=numeric)


def with_first_missed_date(df: DataFrame) -> DataFrame:
    missed_on = first_missed_on(F.col("snapshot_date"), F.col("installments_missed"))
    return df.select("*", missed_on.alias("first_missed_date"))


def with_days_past_due(df: DataFrame) -> DataFrame:
    """Days since the first missed instalment, 0 without arrears.

    Arrears on an instalment of zero have no first missed date and give NULL.
    """
    days = F.datediff("snapshot_date", "first_missed_date")
    return df.select("*", F.when(F.col("overdue_amt") > 0, days).otherwise(0).alias("dpd"))


def silver_loan_daily(raw: DataFrame) -> DataFrame:
    """The whole ledger step.  Narrow: one projection over the raw rows."""
    typed = with_missed_installments(enforce_types(raw))
    return with_days_past_due(with_first_missed_date(zero_fill(typed)))
