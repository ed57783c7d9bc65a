"""Silver feature tables: attributes, financials and clickstream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    clear_tokens,
    keep_at_most,
    keep_between,
    list_length,
    months_of_duration,
    normal_key,
    parse_number,
    parse_whole,
    strict_int,
    to_day,
)
from ..schemas import CLICK_FEATURES
from .rules import Rule, apply_rules, as_is

# Plausible ranges, caps and placeholder spellings of the feeds.
AGE_RANGE = (0, 100)
OCCUPATION_PLACEHOLDER = "_______"
LOAN_COUNT_RANGE = (0, 9)
INCOME_CAP = 180000
PLACEHOLDERS = {
    "Credit_Mix": ("_",),
    "Payment_of_Min_Amount": ("NM",),
    "Payment_Behaviour": ("!@9#%8",),
}
VALID_RANGES = {
    "Num_Bank_Accounts": (0, 11),
    "Num_Credit_Card": (0, 11),
    "Interest_Rate": (0, 34),
    "Num_of_Delayed_Payment": (0, 28),
    "Num_Credit_Inquiries": (0, 17),
}

# Numeric columns of the financials feed, by target type.
WHOLE_COLUMNS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
]
AMOUNT_COLUMNS = [
    "Annual_Income", "Monthly_Inhand_Salary", "Changed_Credit_Limit", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]

# Column order of the silver financials table.
SILVER_FINANCIALS = [
    "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts",
    "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date",
    "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "credit_history_age_months",
    "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly",
    "Payment_Behaviour", "Monthly_Balance", "snapshot_date",
]


def parse_age(text: Column) -> Column:
    return parse_whole(text)


def plausible_age(age: Column) -> Column:
    return keep_between(age, *AGE_RANGE)


KEY_RULE = Rule("Customer_ID", "customer_id", normal_key)
DATE_RULE = Rule("snapshot_date", "snapshot_date", to_day)
AGE_RULE = Rule("Age", "age", lambda text: plausible_age(parse_age(text)))
OCCUPATION_RULE = Rule(
    "Occupation", "occupation", lambda text: clear_tokens(text, OCCUPATION_PLACEHOLDER)
)

# The allow-list of attributes: name and social security number are not on it.
ATTRIBUTE_RULES = [KEY_RULE, AGE_RULE, OCCUPATION_RULE, DATE_RULE]

NUMBER_RULES = [Rule(name, name, parse_whole) for name in WHOLE_COLUMNS] + [
    Rule(name, name, parse_number) for name in AMOUNT_COLUMNS
]
PLACEHOLDER_RULES = [
    Rule(name, name, lambda text, tokens=tokens: clear_tokens(text, *tokens))
    for name, tokens in PLACEHOLDERS.items()
]
RANGE_RULES = [
    Rule(name, name, lambda value, span=span: keep_between(value, *span))
    for name, span in VALID_RANGES.items()
]
CLICK_RULES = [Rule(name, name, strict_int) for name in CLICK_FEATURES]


def silver_attributes(raw: DataFrame) -> DataFrame:
    return apply_rules(raw, ATTRIBUTE_RULES)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    return apply_rules(raw, [KEY_RULE, *CLICK_RULES, DATE_RULE])


def reconciled_count(stated: Column, listed: Column, items: Column) -> Column:
    """A stated loan count checked against the loan list.

    Without a list a plausible statement stands; with one it must agree, and an
    absent or implausible statement is replaced by the length of the list.
    """
    plausible = F.coalesce(stated.between(*LOAN_COUNT_RANGE), F.lit(False))
    return F.when(plausible & (listed.isNull() | (stated == items)), stated).when(
        ~plausible & listed.isNotNull(), items
    )


def consistent_emi(emi: Column, salary: Column, loans: Column) -> Column:
    """A monthly repayment, or NULL where the other columns contradict it.

    Negative amounts, amounts without a loan, and whole amounts above the salary
    are contradictions; an unknown loan count or salary contradicts nothing.
    """
    without_loan = (loans == 0) & (emi > 0)
    whole_above_salary = (emi > 0) & (emi == F.floor(emi)) & (emi > salary)
    refuted = F.coalesce((emi < 0) | without_loan | whole_above_salary, F.lit(False))
    return F.when(~refuted, emi)


def typed_financials(raw: DataFrame) -> DataFrame:
    """Financials after parsing and placeholder removal, before any range or cross-column rule."""
    text_rules = [
        KEY_RULE_RAW_NAME,
        Rule("Type_of_Loan", "Type_of_Loan", lambda text: F.trim(text)),
        Rule("Credit_History_Age", "Credit_History_Age", as_is),
        DATE_RULE,
    ]
    typed = apply_rules(raw, [*text_rules, *NUMBER_RULES, *PLACEHOLDER_RULES])
    return typed.select("*", list_length(F.col("Type_of_Loan")).alias("loan_type_count"))


# Profiles of the financials feed keep its own spelling of the key.
KEY_RULE_RAW_NAME = Rule("Customer_ID", "Customer_ID", normal_key)


def reconcile_loans(typed: DataFrame) -> DataFrame:
    """Typed financials with the reconciled loan count beside the stated one."""
    clean = reconciled_count(F.col("Num_of_Loan"), F.col("Type_of_Loan"), F.col("loan_type_count"))
    return typed.select("*", clean.alias("Num_of_Loan_clean"))


def silver_financials(raw: DataFrame) -> DataFrame:
    """The whole financials step: one chain of projections, no shuffle."""
    checked = reconcile_loans(typed_financials(raw))
    replaced = {rule.target: rule.column() for rule in RANGE_RULES}
    replaced["Num_of_Loan"] = F.col("Num_of_Loan_clean")
    replaced["Annual_Income"] = keep_at_most(F.col("Annual_Income"), INCOME_CAP)
    replaced["Total_EMI_per_month"] = consistent_emi(
        F.col("Total_EMI_per_month"), F.col("Monthly_Inhand_Salary"), F.col("Num_of_Loan_clean")
    )
    replaced["credit_history_age_months"] = months_of_duration(F.col("Credit_History_Age"))
    return checked.select(
        *[replaced.get(name, F.col(name)).alias(name.lower()) for name in SILVER_FINANCIALS]
    )
