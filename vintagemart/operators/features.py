"""Gold feature tables and their assembly on the anchor cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import flag_below, safe_ratio, yes_no_flag
from ..schemas import CLICK_FEATURES, CLICK_MEANS, FEATURE_KEY
from .cleaning import SILVER_FINANCIALS
from .trailing import gate_full_history, trailing_for

# Age of majority, and the derived ratios as numerator over denominator.
MAJORITY_AGE = 18
RATIOS = {
    "emi_to_salary_ratio": ("total_emi_per_month", "monthly_inhand_salary"),
    "debt_to_annual_income_ratio": ("outstanding_debt", "annual_income"),
    "investment_to_salary_ratio": ("amount_invested_monthly", "monthly_inhand_salary"),
    "balance_to_salary_ratio": ("monthly_balance", "monthly_inhand_salary"),
}

COVERAGE_FLAGS = ["has_clickstream", "has_full_clickstream_3m_history"]
COVERAGE_TOTALS = dict(zip(COVERAGE_FLAGS, ["rows_with_clickstream", "rows_with_full_3m_history"]))
DERIVED_FINANCIALS = [*RATIOS, "income_after_emi"]
ENGINEERED = [
    "age_under_18_flag", "emi_to_salary_ratio", "debt_to_annual_income_ratio",
    "pays_minimum_amount_flag", *COVERAGE_FLAGS, *CLICK_MEANS,
]

_FINANCIAL_VALUES = [
    name.lower()
    for name in SILVER_FINANCIALS
    if name.lower() not in (*FEATURE_KEY, "payment_of_min_amount")
]

# The one column order of the feature store, whatever sources a month has.
FEATURE_STORE = [
    *FEATURE_KEY,
    "age", "occupation", "age_under_18_flag",
    *_FINANCIAL_VALUES,
    *DERIVED_FINANCIALS, "pays_minimum_amount_flag",
    *COVERAGE_FLAGS, *CLICK_FEATURES, *CLICK_MEANS,
]


def ratio(name: str) -> Column:
    over, under = RATIOS[name]
    return safe_ratio(F.col(over), F.col(under)).alias(name)


def gold_attributes(silver: DataFrame) -> DataFrame:
    minor = flag_below(F.col("age"), MAJORITY_AGE)
    return silver.select(*FEATURE_KEY, "age", "occupation", minor.alias("age_under_18_flag"))


def gold_financials(silver: DataFrame) -> DataFrame:
    """Silver values, four ratios, the income left after repayments, and the minimum-payment flag."""
    left_over = F.col("monthly_inhand_salary") - F.col("total_emi_per_month")
    return silver.select(
        *FEATURE_KEY,
        *_FINANCIAL_VALUES,
        *[ratio(name) for name in RATIOS],
        left_over.alias("income_after_emi"),
        yes_no_flag(F.col("payment_of_min_amount")).alias("pays_minimum_amount_flag"),
    )


def anchor_left_join(anchor: DataFrame, *sides: DataFrame) -> DataFrame:
    """Every anchor row with the matching row of each side.

    All joins use the same key, so each table is partitioned at most once; which
    side is small enough to broadcast is left to the sizes seen at run time.
    """
    joined = anchor
    for side in sides:
        joined = joined.join(side, FEATURE_KEY, "left")
    return joined


def fill_coverage(joined: DataFrame) -> DataFrame:
    """0 in the coverage flags of unmatched rows; their feature values stay NULL."""
    return joined.fillna(0, subset=COVERAGE_FLAGS)


def feature_store(attributes: DataFrame, financials: DataFrame, clickstream: DataFrame) -> DataFrame:
    """The feature store of all snapshots from the three silver tables.

    A month without a clickstream snapshot needs no case of its own: its rows
    find no match and get the same typed NULLs and flags as any other.
    """
    clicks = gate_full_history(trailing_for(attributes.select(*FEATURE_KEY), clickstream))
    joined = anchor_left_join(gold_attributes(attributes), gold_financials(financials), clicks)
    return fill_coverage(joined).select(*FEATURE_STORE)


def coverage_totals(store: DataFrame) -> DataFrame:
    """Rows with clickstream and with full history over the whole table."""
    return store.agg(*[F.sum(flag).alias(name) for flag, name in COVERAGE_TOTALS.items()])
