"""Trailing means, assembly, and the checks that guard them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vintagemart.operators import checks, cleaning, features, profiling, trailing
from vintagemart.plans.inputs import Inputs
from vintagemart.schemas import CLICK_FEATURES, FEATURE_KEY


@pytest.fixture(scope="module")
def x(spark, small):
    return Inputs(spark, small)


def clicks(spark, rows):
    """(customer, month, value) rows with the same value in every feature."""
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date, v int")
    return df.select(*FEATURE_KEY, *[F.col("v").alias(name) for name in CLICK_FEATURES])


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def means(df):
    return {(r.customer_id, r.snapshot_date): (r.has_full_clickstream_3m_history, r.fe_1_mean_3m) for r in df.collect()}


def test_history_is_by_calendar_and_never_ahead(spark):
    months = [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1), date(2024, 4, 1)]
    df = clicks(spark, [("a", m, 10 * i) for i, m in enumerate(months)])
    expected = {
        ("a", months[0]): (0, None), ("a", months[1]): (0, None), ("a", months[2]): (1, 10.0),
        ("a", months[3]): (1, 20.0), ("a", months[4]): (0, None),
    }
    assert means(trailing.gold_clickstream(df)) == expected
    keyed = trailing.trailing_for(df.select(*FEATURE_KEY), df)
    assert means(trailing.gate_full_history(keyed)) == expected


def test_gate_counts_months_and_mean_skips_nulls(spark):
    df = clicks(spark, [("a", date(2024, 1, 1), 1), ("a", date(2024, 2, 1), None), ("a", date(2024, 3, 1), 4)])
    assert means(trailing.gold_clickstream(df))[("a", date(2024, 3, 1))] == (1, 2.5)


def test_both_forms_agree(x):
    keyed = trailing.trailing_for(x.silver_clicks.select(*FEATURE_KEY), x.silver_clicks)
    assert same(trailing.trailing_window(x.silver_clicks), keyed)


@pytest.mark.parametrize("build", [
    trailing.trailing_window,
    lambda df: trailing.trailing_for(df.select(*FEATURE_KEY).distinct(), df),
])
def test_repeated_key_fails_the_query(spark, build):
    df = clicks(spark, [("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 1), 2)])
    with pytest.raises(Exception, match="repeated"):
        build(df).collect()


@pytest.mark.parametrize("read", [
    lambda gold: gold,
    lambda gold: gold.select("snapshot_date", "has_full_clickstream_3m_history"),
    lambda gold: gold.groupBy().count(),
    profiling.history_availability,
])
def test_repeated_key_fails_whatever_is_read(spark, read):
    df = clicks(spark, [("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 1), 2)])
    with pytest.raises(Exception, match="repeated"):
        read(trailing.gold_clickstream(df)).collect()


@pytest.mark.parametrize("months", [1, 2])
def test_repeated_cohort_key_is_told_from_a_repeated_clickstream_key(spark, months):
    df = clicks(spark, [("a", date(2024, m + 1, 1), 1) for m in range(months)])
    keys = df.select(*FEATURE_KEY)
    with pytest.raises(Exception, match="cohort: repeated"):
        trailing.trailing_for(keys.unionAll(keys), df).collect()


def test_plans_of_the_trailing_means(spark, small, x):
    window = trailing.trailing_window(clicks(spark, [("a", date(2024, 1, 1), 1)]))._jdf.queryExecution().executedPlan().toString()
    assert window.count("Exchange") == 1
    store = x.feature_store._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in store and "transform(" not in store


def test_no_event_is_left_out(spark, small, x):
    events = x.table("events")
    assert x.feed("clickstream").count() == events.selectExpr("user_id", "extract(day from ts)").distinct().count()


def test_store_equals_plain_joins(x):
    plain = features.anchor_left_join(x.gold_attributes, x.gold_financials, x.gold_clicks)
    assert same(x.feature_store, features.fill_coverage(plain))
    assert x.feature_store.count() == x.silver_attributes.count()


def test_store_has_72_columns_in_one_order_without_clickstream(x):
    without = features.feature_store(x.silver_attributes, x.silver_financials, x.silver_clicks.limit(0))
    assert without.schema == x.feature_store.schema
    assert len(without.columns) == 72
    assert without.agg(F.sum("has_clickstream"), F.count("fe_1")).first() == (0, 0)


def test_padded_keys_join(x):
    padded = cleaning.silver_financials(
        x.feed("financials").withColumn("Customer_ID", F.concat(F.lit(" "), "Customer_ID", F.lit(" ")))
    )
    assert same(x.silver_financials, padded)


def test_duplicate_keys_group_nulls(spark):
    rows = [(None, None), (None, None), ("a", None), ("a", date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date date")
    assert [tuple(r) for r in checks.duplicate_keys(df).collect()] == [(None, None, 2)]
    with pytest.raises(checks.CheckFailed, match="t: 1 repeated"):
        checks.require_unique(df, "t")
    checks.require_unique(df.dropna(), "t")


def test_row_parity(spark):
    a = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 2, 1),)], "snapshot_date date")
    doubled = checks.row_parity(a, a.unionAll(a.filter("snapshot_date = date'2024-02-01'"))).orderBy("snapshot_date").collect()
    assert [tuple(r)[1:] for r in doubled] == [(1, 1, 1), (1, 2, 0)]
    counts = {date(2024, 1, 1): 1, date(2024, 2, 1): 1}
    checks.require_row_parity(counts, dict(counts), "t")
    with pytest.raises(checks.CheckFailed, match="None: anchor 0, joined 1; 2024-02-01: anchor 1, joined 2"):
        checks.require_row_parity(counts, counts | {date(2024, 2, 1): 2, None: 1}, "t")


@pytest.mark.parametrize("bits", [1 << 16, checks.FILTER_BITS])
def test_keys_that_miss_the_filter_are_in_no_table(spark, bits):
    """A full filter tells nothing, a roomy one nearly all; neither loses a key."""
    held = spark.range(0, 40_000, 2).select(F.col("id").cast("string").alias("customer_id"), F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    asked = spark.range(40_000).select(F.col("id").cast("string").alias("customer_id"), F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    found = checks.with_membership(asked, checks.membership(held, bits=bits), bits=bits)
    assert found.columns == ["customer_id", "snapshot_date", "may_match"]
    missed = found.filter("not may_match")
    assert missed.join(held, FEATURE_KEY, "left_semi").count() == 0
    assert found.count() == 40_000 and missed.count() >= (19_900 if bits == checks.FILTER_BITS else 10_000)
    null = asked.limit(1).withColumn("customer_id", F.lit(None).cast("string"))
    assert checks.with_membership(null, checks.membership(null)).first().may_match is False


@pytest.mark.parametrize("unique", [False, True])
def test_unmatched_keys_of_tables_with_their_grain(spark, unique, monkeypatch):
    monkeypatch.setattr(checks, "FILTER_BITS", 1 << 16)
    day = F.lit("2024-01-01").cast("date").alias("snapshot_date")
    left = spark.range(0, 3000).select(F.col("id").cast("string").alias("customer_id"), day)
    right = spark.range(2000, 9000).select(F.col("id").cast("string").alias("customer_id"), day)
    found = checks.unmatched_keys(left, right, "l", "r", unique=unique).groupBy("only_in").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("d"))
    assert {(r.only_in, r.n, r.d) for r in found.collect()} == {("l", 2000, 2000), ("r", 6000, 6000)}
    plan = checks.unmatched_keys(left, right, "l", "r", unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_unmatched_keys_treat_null_as_unmatched(spark):
    schema = "customer_id string, snapshot_date date"
    day = date(2024, 1, 1)
    left = spark.createDataFrame([("a", day), ("b", day), ("b", day), (None, day)], schema)
    right = spark.createDataFrame([("a", day), ("c", day), (None, day)], schema)
    found = {tuple(r) for r in checks.unmatched_keys(left, right, "l", "r").collect()}
    assert found == {("b", day, "l"), ("c", day, "r"), (None, day, "l"), (None, day, "r")}
    for a, b, name in ((left, right, "l"), (right, left, "r")):
        anti = a.distinct().join(b, FEATURE_KEY, "left_anti")
        assert {tuple(r) for r in anti.collect()} == {k[:2] for k in found if k[2] == name}
