"""Edge cases of the cleaning rules, on rows written by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagemart import functions as X
from vintagemart.operators import cleaning, ledger, labels
from vintagemart.schemas import LEDGER


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    """Rules must not depend on how the session treats bad casts."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_dirty_numbers(spark, ansi):
    texts = ["52312.68_", " 2_ ", "_", "___", "__10000__", "__-333333333333333333333333333__", "____",
             "__10", "-5.5", "", None, "abc", "1e3", "7__"]
    assert apply(spark, X.parse_number, texts) == [
        52312.68, 2.0, None, None, None, None, None, None, -5.5, None, None, None, 1000.0, 7.0]


def test_whole_numbers_go_through_double(spark, ansi):
    texts = ["3.0", "2_", "-100", "2.9", "99999999999", "_", None]
    assert apply(spark, X.parse_whole, texts) == [3, 2, -100, 2, None, None, None]


def test_strict_int(spark, ansi):
    assert apply(spark, X.strict_int, [" 5 ", "-7", "3.0", "bad", "", None, "99999999999"]) == [
        5, -7, None, None, None, None, None]


def test_age(spark, ansi):
    def rule(text):
        return cleaning.plausible_age(cleaning.parse_age(text))

    assert apply(spark, rule, ["41_", "2329_", "-500", "0", "100", "101", "-1", "23.0", None]) == [
        41, None, None, 0, 100, None, None, 23, None]


def test_placeholders(spark):
    def occupation(text):
        return X.clear_tokens(text, cleaning.OCCUPATION_PLACEHOLDER)

    assert apply(spark, occupation, ["_______", " _______ ", "______", " Writer ", "", None]) == [
        None, None, "______", "Writer", "", None]


def test_missing_words(spark):
    words = ["", "  ", "Unknown", "N/A", "na", "NaN", "NULL", "none", None, "x", "nap"]
    assert apply(spark, X.is_missing_text, words) == [True] * 9 + [False] * 2


def test_list_length(spark):
    texts = ["A", "A, B", "A, B, and C", "A, and B", "A,B,  and  C", "", None, "Band and Co"]
    assert apply(spark, X.list_length, texts) == [1, 2, 3, 2, 3, 1, 0, 1]


def test_durations(spark, ansi):
    texts = ["16 Years and 2 Months", "1 Year and 1 Month", "  3 Years  and 0 Months ", "NA", "16 Years", "",
             None, "x 16 Years and 2 Months", "999999999 Years and 1 Months", "99999999999 Years and 1 Months"]
    assert apply(spark, X.months_of_duration, texts) == [194, 13, 36, None, None, None, None, None, None, None]


def test_dates(spark, ansi):
    assert apply(spark, X.to_day, [" 2024-02-01 ", "2024-02-30", "01/02/2024", "", None]) == [
        date(2024, 2, 1), None, None, None, None]


@pytest.mark.parametrize("stated, listed, items, expected", [
    (3, None, 0, 3), (0, None, 0, 0), (12, None, 0, None), (-100, None, 0, None), (None, None, 0, None),
    (2, "A, B", 2, 2), (3, "A, B", 2, None), (1353, "A, B", 2, 2), (-1, "A, B", 2, 2), (None, "A, B", 2, 2),
])
def test_reconciled_count(spark, stated, listed, items, expected):
    df = spark.createDataFrame([(stated, listed, items)], "n int, t string, k int")
    assert df.select(cleaning.reconciled_count(F.col("n"), F.col("t"), F.col("k"))).first()[0] == expected


@pytest.mark.parametrize("emi, salary, loans, expected", [
    (-5.5, 1000.0, 1, None), (100.5, 1000.0, 0, None), (0.0, 1000.0, 0, 0.0), (82331.0, 1000.0, 2, None),
    (82331.0, None, 2, 82331.0), (82331.5, 1000.0, 2, 82331.5), (500.0, 1000.0, 2, 500.0),
    (100.5, 1000.0, None, 100.5), (None, 1000.0, 0, None),
])
def test_consistent_emi(spark, emi, salary, loans, expected):
    df = spark.createDataFrame([(emi, salary, loans)], "e double, s double, l int")
    assert df.select(cleaning.consistent_emi(F.col("e"), F.col("s"), F.col("l"))).first()[0] == expected


def test_income_cap_keeps_negatives(spark):
    def rule(value):
        return X.keep_at_most(value, cleaning.INCOME_CAP)

    assert apply(spark, rule, [180000.0, 180000.01, -5.0, None], "double") == [180000.0, None, -5.0, None]


@pytest.mark.parametrize("a, b, expected", [
    (1.0, 2.0, 0.5), (1.0, 0.0, None), (1.0, -2.0, None), (None, 2.0, None), (1.0, None, None), (-1.0, 2.0, -0.5)])
def test_safe_ratio(spark, ansi, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(X.safe_ratio(F.col("a"), F.col("b"))).first()[0] == expected


def test_flags(spark):
    assert apply(spark, lambda v: X.flag_below(v, 18), [17, 18, None], "int") == [1, 0, None]
    assert apply(spark, X.yes_no_flag, ["Yes", "No", "NM", None, "yes"]) == [1, 0, None, None, None]


def loan(**changes):
    row = dict(loan_id="L", Customer_ID="C", loan_start_date=date(2023, 1, 1), tenure=10, installment_num=6,
               loan_amt=1000.0, due_amt=100.0, paid_amt=0.0, overdue_amt=0.0, balance=500.0,
               snapshot_date=date(2024, 3, 31))
    return tuple({**row, **changes}[f.name] for f in LEDGER)


@pytest.mark.parametrize("changes, missed, first, dpd, label", [
    ({}, 0, None, 0, 0),
    ({"overdue_amt": 100.0}, 1, date(2024, 2, 29), 31, 1),
    ({"overdue_amt": 101.0}, 2, date(2024, 1, 31), 60, 1),
    ({"overdue_amt": 50.0, "due_amt": 0.0}, 0, None, None, 0),
    ({"overdue_amt": -250.0}, -2, None, 0, 0),
    ({"overdue_amt": None}, 0, None, 0, 0),
    ({"due_amt": None, "overdue_amt": 5.0}, 0, None, None, 0),
])
def test_ledger(spark, ansi, changes, missed, first, dpd, label):
    silver = ledger.silver_loan_daily(spark.createDataFrame([loan(**changes)], LEDGER))
    row = silver.first()
    assert (row.installments_missed, row.first_missed_date, row.dpd) == (missed, first, dpd)
    assert labels.label_store(silver).first().label == label


def test_zero_fill_reaches_every_number(spark):
    empty = loan(tenure=None, installment_num=None, loan_amt=None, paid_amt=None, balance=None)
    row = ledger.silver_loan_daily(spark.createDataFrame([empty], LEDGER)).first()
    assert (row.tenure, row.installment_num, row.mob, row.loan_amt, row.paid_amt, row.balance) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_cleaning_is_idempotent_and_keeps_rows(spark, small):
    from vintagemart.sources import standins

    raw = standins.financials(spark, small)
    once = cleaning.typed_financials(raw)
    again = cleaning.typed_financials(once.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]))
    assert once.count() == raw.count()
    assert once.exceptAll(again).count() == 0
