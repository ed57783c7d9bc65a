"""Labels, features, their assembly and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import yes_no_flag
from ..operators import checks, features, labels, trailing
from ..schemas import CLICK_FEATURES, CLICK_MEANS, FEATURE_KEY
from .inputs import Inputs
from .registry import query

DEFINITIONS = [(30, 6), (60, 6), (90, 6), (30, 3), (30, 9)]
RAW = ", ".join(trailing.RAW_MEANS)
FES = ", ".join(CLICK_FEATURES)
MEANS = ", ".join(CLICK_MEANS)


@query(
    "label_definition",
    "\nunion all\n".join(
        f"select loan_id, Customer_ID, case when dpd >= {d} then 1 else 0 end as label, "
        f"'{d}dpd_{m}mob' as label_def, snapshot_date from silver_loan where mob = {m}"
        for d, m in DEFINITIONS
    ),
)
def label_definition(x: Inputs) -> DataFrame:
    return labels.labels_for_definitions(x.silver_loans, DEFINITIONS)


@query("gold_label_store", "select * from labels30")
def gold_label_store(x: Inputs) -> DataFrame:
    return x.labels


@query(
    "safe_ratio",
    "select customer_id, snapshot_date, emi_to_salary_ratio, debt_to_annual_income_ratio, "
    "investment_to_salary_ratio, balance_to_salary_ratio from gold_financials",
)
def safe_ratio(x: Inputs) -> DataFrame:
    return x.silver_financials.select(*FEATURE_KEY, *[features.ratio(name) for name in features.RATIOS])


@query("gold_attributes", "select * from gold_attributes")
def gold_attributes(x: Inputs) -> DataFrame:
    return x.gold_attributes


@query(
    "duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_keys(x: Inputs) -> DataFrame:
    return checks.duplicate_keys(x.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("yes_no_flag", "select customer_id, snapshot_date, pays_minimum_amount_flag from gold_financials")
def yes_no(x: Inputs) -> DataFrame:
    flag = yes_no_flag(F.col("payment_of_min_amount"))
    return x.silver_financials.select(*FEATURE_KEY, flag.alias("pays_minimum_amount_flag"))


@query("gold_financials", "select * from gold_financials")
def gold_financials(x: Inputs) -> DataFrame:
    return x.gold_financials


@query(
    "rolling_mean_grouped",
    f"""
    select c.customer_id, c.snapshot_date, count(distinct h.snapshot_date) as history_months,
     {', '.join(f'avg(h.{c}) as {c}_mean_3m_raw' for c in CLICK_FEATURES)}
    from silver_clickstream c join silver_clickstream h on h.customer_id = c.customer_id
     and h.snapshot_date in (c.snapshot_date, cast(c.snapshot_date - interval 1 month as date),
                             cast(c.snapshot_date - interval 2 month as date))
    group by 1, 2
    """,
)
def rolling_mean_grouped(x: Inputs) -> DataFrame:
    clicks = x.silver_clicks
    rows = trailing.trailing_for(clicks.select(*FEATURE_KEY), clicks)
    return rows.select(*FEATURE_KEY, "history_months", *trailing.RAW_MEANS)


@query("rolling_mean_window", f"select customer_id, snapshot_date, history_months, {RAW} from rolled")
def rolling_mean_window(x: Inputs) -> DataFrame:
    rows = trailing.trailing_window(x.silver_clicks)
    return rows.select(*FEATURE_KEY, "history_months", *trailing.RAW_MEANS)


@query(
    "full_history_gate",
    f"select customer_id, snapshot_date, has_full_clickstream_3m_history, {MEANS} from gold_clickstream",
)
def full_history_gate(x: Inputs) -> DataFrame:
    clicks = x.silver_clicks
    gated = trailing.gate_full_history(trailing.trailing_for(clicks.select(*FEATURE_KEY), clicks))
    return gated.select(*FEATURE_KEY, "has_full_clickstream_3m_history", *CLICK_MEANS)


@query("gold_clickstream", "select * from gold_clickstream")
def gold_clickstream(x: Inputs) -> DataFrame:
    return x.gold_clicks


@query("anchor_left_join", "select * from joined")
def anchor_left_join(x: Inputs) -> DataFrame:
    return features.anchor_left_join(x.gold_attributes, x.gold_financials, x.gold_clicks)


@query(
    "absent_source_nulls",
    f"""
    select * exclude (gone, late) replace (
      case when gone then 0 else has_clickstream end as has_clickstream,
      case when late then 0 else has_full_clickstream_3m_history end as has_full_clickstream_3m_history,
      {', '.join(f'case when gone then null else {c} end as {c}' for c in CLICK_FEATURES)},
      {', '.join(f'case when late then null else {c} end as {c}' for c in CLICK_MEANS)})
    from (select *, snapshot_date = date '2024-01-01' as gone,
           snapshot_date between date '2024-01-01' and date '2024-03-01' as late from feature_store)
    """,
)
def absent_source_nulls(x: Inputs) -> DataFrame:
    """The store when one month has no clickstream: that month and two means after it are affected."""
    absent = x.silver_clicks.filter(F.col("snapshot_date") != F.lit("2024-01-01").cast("date"))
    return features.feature_store(x.silver_attributes, x.silver_financials, absent)


@query("gold_feature_store", "select * from feature_store")
def gold_feature_store(x: Inputs) -> DataFrame:
    return x.feature_store


@query(
    "row_parity",
    """
    select snapshot_date, a.n as anchor_rows, j.n as joined_rows, cast(a.n = j.n as int) as matches
    from (select snapshot_date, count(*) as n from gold_attributes group by 1) a
    join (select snapshot_date, count(*) as n from feature_store group by 1) j using (snapshot_date)
    """,
)
def row_parity(x: Inputs) -> DataFrame:
    return checks.row_parity(x.gold_attributes, x.feature_store)


@query(
    "coverage_totals",
    """
    select cast(sum(has_clickstream) as bigint) as rows_with_clickstream,
     cast(sum(has_full_clickstream_3m_history) as bigint) as rows_with_full_3m_history from feature_store
    """,
)
def coverage_totals(x: Inputs) -> DataFrame:
    return features.coverage_totals(x.feature_store)


ALIGNED = """
select loan_id, trim(Customer_ID) as customer_id, label, label_def, snapshot_date as label_snapshot_date,
 cast(snapshot_date - interval 6 month as date) as feature_snapshot_date from labels30
"""


@query("label_feature_alignment", ALIGNED)
def label_feature_alignment(x: Inputs) -> DataFrame:
    return labels.align_with_features(x.labels)


@query(
    "label_date_map",
    f"select distinct label_snapshot_date, feature_snapshot_date from ({ALIGNED}) order by 1",
)
def label_date_map(x: Inputs) -> DataFrame:
    return labels.label_date_map(labels.align_with_features(x.labels))
