"""Cross-column audits of the financials: loans, income, repayments, durations.

All take the typed, reconciled financials (``cleaning.reconcile_loans``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import months_of_duration, safe_ratio
from .profiling import rows_where, value_spread

# Rows shown of the largest repayments, and the ratio worth a look.
LARGEST = 50
HIGH_INCOME_RATIO = 1.5


def _emi() -> Column:
    return F.col("Total_EMI_per_month")


def _salary() -> Column:
    return F.col("Monthly_Inhand_Salary")


def _row_key() -> list[str]:
    return ["Customer_ID", "snapshot_date"]


def loan_count_mismatch(typed: DataFrame) -> DataFrame:
    """Rows whose stated loan count differs from the listed one; NULL is a value."""
    differs = ~F.col("Num_of_Loan").eqNullSafe(F.col("loan_type_count"))
    return typed.filter(differs).select(*_row_key(), "Type_of_Loan", "Num_of_Loan", "loan_type_count")


def with_income_ratio(typed: DataFrame) -> DataFrame:
    """Stated annual income over twelve salaries."""
    ratio = safe_ratio(F.col("Annual_Income"), _salary() * 12)
    return typed.select("*", ratio.alias("annual_income_to_salary_ratio"))


def income_salary_summary(typed: DataFrame) -> DataFrame:
    return value_spread(
        with_income_ratio(typed),
        ["Annual_Income", "Monthly_Inhand_Salary", "annual_income_to_salary_ratio"],
        {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99},
    ).drop("negative_rows")


def high_income_ratio(typed: DataFrame, above: float = HIGH_INCOME_RATIO) -> DataFrame:
    """Rows whose income is far above their salary, by income."""
    return (
        with_income_ratio(typed)
        .filter(F.col("annual_income_to_salary_ratio") > above)
        .select(*_row_key(), "Annual_Income", "Monthly_Inhand_Salary", "annual_income_to_salary_ratio")
        .orderBy("Annual_Income", *_row_key())
    )


def largest_repayments(reconciled: DataFrame, limit: int = LARGEST) -> DataFrame:
    """The rows with the largest repayment and its share of the salary."""
    share = safe_ratio(_emi(), _salary())
    return (
        reconciled.select(
            *_row_key(),
            "Num_of_Loan_clean",
            "Total_EMI_per_month",
            "Monthly_Inhand_Salary",
            share.alias("emi_to_salary_ratio"),
        )
        .orderBy(F.desc("Total_EMI_per_month"), *_row_key())
        .limit(limit)
    )


def without_loans(reconciled: DataFrame) -> DataFrame:
    """Rows without loans, largest repayment first."""
    return (
        reconciled.filter("Num_of_Loan_clean = 0")
        .select(*_row_key(), "Num_of_Loan_clean", "Type_of_Loan", "Total_EMI_per_month")
        .orderBy(F.desc("Total_EMI_per_month"), *_row_key())
    )


def repaying_without_loans(reconciled: DataFrame) -> DataFrame:
    """Number of rows that repay although they have no loan."""
    return reconciled.agg(rows_where((F.col("Num_of_Loan_clean") == 0) & (_emi() > 0)).alias("n_rows"))


def repayment_above_salary(reconciled: DataFrame) -> DataFrame:
    return reconciled.filter(_emi() > _salary()).select(
        *_row_key(), "Total_EMI_per_month", "Monthly_Inhand_Salary", "Num_of_Loan_clean"
    )


def _whole_repayments(reconciled: DataFrame) -> DataFrame:
    return reconciled.filter((_emi() > 0) & (_emi() == F.floor(_emi())))


def whole_repayment_split(reconciled: DataFrame) -> DataFrame:
    """Whole-number repayments below and above the salary, per reconciled loan count."""
    return (
        _whole_repayments(reconciled)
        .groupBy("Num_of_Loan_clean")
        .agg(
            rows_where(_emi() < _salary()).alias("emi_below_salary"),
            rows_where(_emi() > _salary()).alias("emi_above_salary"),
        )
        .orderBy("Num_of_Loan_clean")
    )


def whole_repayment_totals(reconciled: DataFrame) -> DataFrame:
    return _whole_repayments(reconciled).agg(
        rows_where(_emi() < _salary()).alias("emi_below_salary"),
        rows_where(_emi() > _salary()).alias("emi_above_salary"),
    )


def duration_range(typed: DataFrame) -> DataFrame:
    """Shortest and longest credit history in months, and rows without one."""
    months = months_of_duration(F.col("Credit_History_Age"))
    return typed.agg(
        F.min(months).alias("min_months"),
        F.max(months).alias("max_months"),
        rows_where(months.isNull()).alias("null_months"),
    )
