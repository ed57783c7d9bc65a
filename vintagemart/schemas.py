"""Declared schemas and column lists of the four feeds and the derived tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _strings(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Column names, orders and types of the source feeds.
LEDGER = StructType([
    StructField("loan_id", StringType()),
    StructField("Customer_ID", StringType()),
    StructField("loan_start_date", DateType()),
    StructField("tenure", IntegerType()),
    StructField("installment_num", IntegerType()),
    StructField("loan_amt", FloatType()),
    StructField("due_amt", FloatType()),
    StructField("paid_amt", FloatType()),
    StructField("overdue_amt", FloatType()),
    StructField("balance", FloatType()),
    StructField("snapshot_date", DateType()),
])

ATTRIBUTES = _strings(["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"])

FINANCIALS = _strings([
    "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts",
    "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Type_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio",
    "Credit_History_Age", "Payment_of_Min_Amount", "Total_EMI_per_month",
    "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance", "snapshot_date",
])

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]
CLICK_MEANS = [f"{name}_mean_3m" for name in CLICK_FEATURES]
CLICKSTREAM = _strings(["Customer_ID", *CLICK_FEATURES, "snapshot_date"])

FEEDS = {
    "loan_daily": LEDGER,
    "attributes": ATTRIBUTES,
    "financials": FINANCIALS,
    "clickstream": CLICKSTREAM,
}

FEATURE_KEY = ["customer_id", "snapshot_date"]
