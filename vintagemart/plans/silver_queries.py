"""Typing, cleaning and derivation rules, one by one and as silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from ..functions import list_length, months_of_duration, normal_key, to_day
from ..operators import cleaning, ledger
from ..operators.rules import Rule, apply_rules, as_is
from . import oracle as O
from .inputs import Inputs
from .registry import query

LOAN_KEY = ["loan_id", "snapshot_date"]
CUSTOMER = Rule("Customer_ID", "Customer_ID", as_is)


def _all_text(df: DataFrame) -> DataFrame:
    """Every column as text, whole numbers with a decimal point."""
    whole = {f.name for f in df.schema if isinstance(f.dataType, IntegerType)}
    return df.select(*[(F.col(c).cast("double") if c in whole else F.col(c)).cast("string").alias(c) for c in df.columns])


@query("enforce_schema", "select * from fx_loan_daily")
def enforce_schema(x: Inputs) -> DataFrame:
    """The ledger from its text form back to its declared types."""
    return ledger.enforce_types(_all_text(x.feed("loan_daily")))


@query("installments_missed", "select loan_id, snapshot_date, mob, installments_missed from missed_loan")
def installments_missed(x: Inputs) -> DataFrame:
    missed = ledger.with_missed_installments(x.feed("loan_daily"))
    return missed.select(*LOAN_KEY, "mob", "installments_missed")


@query("zero_fill_numeric", "select * from filled_loan")
def zero_fill_numeric(x: Inputs) -> DataFrame:
    return ledger.zero_fill(ledger.with_missed_installments(x.feed("loan_daily")))


@query("first_missed_date", "select loan_id, snapshot_date, installments_missed, first_missed_date from dated_loan")
def first_missed_date(x: Inputs) -> DataFrame:
    return x.silver_loans.select(*LOAN_KEY, "installments_missed", "first_missed_date")


@query("days_past_due", "select loan_id, snapshot_date, overdue_amt, dpd from silver_loan")
def days_past_due(x: Inputs) -> DataFrame:
    return x.silver_loans.select(*LOAN_KEY, "overdue_amt", "dpd")


@query("silver_loan_daily", "select * from silver_loan")
def silver_loan_daily(x: Inputs) -> DataFrame:
    return x.silver_loans


@query("parse_trailing_underscore_int", f"select Customer_ID, Age as raw_age, {O.AGE} as age from fx_attributes")
def parse_trailing_underscore_int(x: Inputs) -> DataFrame:
    return apply_rules(
        x.feed("attributes"), [CUSTOMER, Rule("Age", "raw_age", as_is), Rule("Age", "age", cleaning.parse_age)]
    )


@query("null_out_of_range_age", "select customer_id, age from silver_attributes")
def null_out_of_range_age(x: Inputs) -> DataFrame:
    return apply_rules(x.feed("attributes"), [cleaning.KEY_RULE, cleaning.AGE_RULE])


@query("null_placeholder_exact", "select customer_id, occupation from silver_attributes")
def null_placeholder_exact(x: Inputs) -> DataFrame:
    return apply_rules(x.feed("attributes"), [cleaning.KEY_RULE, cleaning.OCCUPATION_RULE])


@query("drop_pii", "select Customer_ID, Age, Occupation, snapshot_date from fx_attributes")
def drop_pii(x: Inputs) -> DataFrame:
    allowed = [Rule(rule.source, rule.source, as_is) for rule in cleaning.ATTRIBUTE_RULES]
    return apply_rules(x.feed("attributes"), allowed)


@query("silver_attributes", "select * from silver_attributes")
def silver_attributes(x: Inputs) -> DataFrame:
    return x.silver_attributes


@query("parse_dirty_numeric", f"select Customer_ID, {', '.join(O.INTS + O.DOUBLES)} from typed_fin")
def parse_dirty_numeric(x: Inputs) -> DataFrame:
    return apply_rules(x.feed("financials"), [CUSTOMER, *cleaning.NUMBER_RULES])


@query(
    "null_placeholder_set",
    "select Customer_ID, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour from typed_fin",
)
def null_placeholder_set(x: Inputs) -> DataFrame:
    return apply_rules(x.feed("financials"), [CUSTOMER, *cleaning.PLACEHOLDER_RULES])


@query("list_item_count", "select Customer_ID, Type_of_Loan, loan_type_count from typed_fin")
def list_item_count(x: Inputs) -> DataFrame:
    return apply_rules(
        x.feed("financials"),
        [
            CUSTOMER,
            Rule("Type_of_Loan", "Type_of_Loan", normal_key),
            Rule("Type_of_Loan", "loan_type_count", lambda text: list_length(F.trim(text))),
        ],
    )


@query("reconcile_loan_count", "select Customer_ID, Num_of_Loan, loan_type_count, Num_of_Loan_clean from checked_fin")
def reconcile_loan_count(x: Inputs) -> DataFrame:
    return x.reconciled.select("Customer_ID", "Num_of_Loan", "loan_type_count", "Num_of_Loan_clean")


@query("cap_annual_income", "select customer_id, annual_income from silver_financials")
def cap_annual_income(x: Inputs) -> DataFrame:
    return x.silver_financials.select("customer_id", "annual_income")


@query("clean_emi", "select customer_id, total_emi_per_month from silver_financials")
def clean_emi(x: Inputs) -> DataFrame:
    return x.silver_financials.select("customer_id", "total_emi_per_month")


@query(
    "parse_duration_months",
    f"select Customer_ID, Credit_History_Age, {O.MONTHS} as credit_history_age_months from fx_financials",
)
def parse_duration_months(x: Inputs) -> DataFrame:
    return apply_rules(
        x.feed("financials"),
        [
            CUSTOMER,
            Rule("Credit_History_Age", "Credit_History_Age", as_is),
            Rule("Credit_History_Age", "credit_history_age_months", months_of_duration),
        ],
    )


@query(
    "apply_range_rules",
    "select customer_id as Customer_ID, num_bank_accounts as Num_Bank_Accounts, num_credit_card as Num_Credit_Card, "
    "interest_rate as Interest_Rate, num_of_delayed_payment as Num_of_Delayed_Payment, "
    "num_credit_inquiries as Num_Credit_Inquiries from silver_financials",
)
def apply_range_rules(x: Inputs) -> DataFrame:
    return apply_rules(x.typed_financials, [CUSTOMER, *cleaning.RANGE_RULES])


@query("silver_financials", "select * from silver_financials")
def silver_financials(x: Inputs) -> DataFrame:
    return x.silver_financials


@query("parse_int_columns", f"select Customer_ID, {', '.join(O.strict(c) + ' as ' + c for c in O.CLICK_FEATURES)} from fx_clickstream")
def parse_int_columns(x: Inputs) -> DataFrame:
    return apply_rules(x.feed("clickstream"), [CUSTOMER, *cleaning.CLICK_RULES])


@query(
    "parse_snapshot_date",
    "select customer_id, snapshot_date from silver_attributes union all "
    "select customer_id, snapshot_date from silver_financials union all "
    "select customer_id, snapshot_date from silver_clickstream",
)
def parse_snapshot_date(x: Inputs) -> DataFrame:
    """Dates of the three text feeds, with blanks put around them first."""
    feeds = [x.feed(name).select("Customer_ID", "snapshot_date") for name in ("attributes", "financials", "clickstream")]
    texts = feeds[0].unionByName(feeds[1]).unionByName(feeds[2])
    padded = F.concat(F.lit("  "), "snapshot_date", F.lit(" "))
    return texts.select(F.col("Customer_ID").alias("customer_id"), to_day(padded).alias("snapshot_date"))


@query(
    "normalise_key",
    "select customer_id from silver_attributes union all select customer_id from silver_financials "
    "union all select customer_id from silver_clickstream",
)
def normalise_key(x: Inputs) -> DataFrame:
    """Keys of the three text feeds, with blanks put around them first."""
    feeds = [x.feed(name).select("Customer_ID") for name in ("attributes", "financials", "clickstream")]
    keys = feeds[0].unionByName(feeds[1]).unionByName(feeds[2])
    return keys.select(normal_key(F.concat(F.lit(" "), "Customer_ID", F.lit("  "))).alias("customer_id"))


@query("silver_clickstream", "select * from silver_clickstream")
def silver_clickstream(x: Inputs) -> DataFrame:
    return x.silver_clicks
