"""Profiles and data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import association, audits, checks, cleaning, features, ordered, profiling
from ..operators.rules import Rule, apply_rules
from ..schemas import CLICK_FEATURES, FEATURE_KEY, FEEDS
from ..sources.scratch import scratch_path
from ..sources.snapshots import snapshots_present
from . import oracle as O
from .backfill import Mart, clean
from .inputs import Inputs
from .registry import query

RAW_FEEDS = ["attributes", "financials", "clickstream"]
RAW_KEY = ["Customer_ID", "snapshot_date"]
LINE_KEY = ["l_orderkey", "l_linenumber"]

# The columns each profile is about.
COUNTS = [*O.INTS, "Changed_Credit_Limit"]
MONEY = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Total_EMI_per_month",
         "Amount_invested_monthly", "Monthly_Balance"]
TEXTS = ["Customer_ID", "Type_of_Loan", "Credit_Mix", "Credit_History_Age",
         "Payment_of_Min_Amount", "Payment_Behaviour"]
CATEGORIES = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
NUMERIC = cleaning.WHOLE_COLUMNS + cleaning.AMOUNT_COLUMNS
COLUMNS = {t: FEEDS[t].names for t in RAW_FEEDS}

# The forms numeric text may have, as the oracles spell them.
NUMBER = r"^-?\d+(\.\d+)?$"
TRAILING = r"^-?\d+(\.\d+)?_+$"


def _stack(frames: dict[str, DataFrame]) -> DataFrame:
    """One table of several, each row with the name of its own."""
    named = [df.select(F.lit(name).alias("table"), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, named)


def _sum_if(condition: str) -> str:
    return f"cast(coalesce(sum(case when {condition} then 1 else 0 end), 0) as bigint)"


def _each_feed(sql: str) -> str:
    return "\nunion all\n".join(
        f"select '{t}' as \"table\", q.* from ({sql.replace('{t}', 'fx_' + t).replace('{n}', str(len(COLUMNS[t])))}) q"
        for t in RAW_FEEDS
    )


# Keys, duplicates, missing values

@query(
    "profile_partitions",
    _each_feed(
        "select snapshot_date, count(*) as n_rows, {n} as n_columns, count(distinct Customer_ID) as distinct_keys, "
        "cast(count(*) = count(distinct Customer_ID) as int) as key_is_unique from {t} group by 1"
    ),
)
def profile_partitions(x: Inputs) -> DataFrame:
    return _stack({t: profiling.profile_partitions(x.feed(t), "Customer_ID") for t in RAW_FEEDS})


@query(
    "exact_duplicate_rows",
    _each_feed("select (select count(*) from {t}) - (select count(*) from (select distinct * from {t})) as duplicate_rows")
    + " union all select 'lineitem', (select count(*) from lineitem) - "
    "(select count(*) from (select distinct * from lineitem))",
)
def exact_duplicate_rows(x: Inputs) -> DataFrame:
    tables = {t: x.feed(t) for t in RAW_FEEDS}
    tables["lineitem"] = x.table("lineitem")
    return _stack({t: profiling.exact_duplicate_rows(df) for t, df in tables.items()})


@query(
    "duplicated_key_pairs",
    _each_feed("select count(*) as duplicated_pairs from (select 1 from {t} group by Customer_ID, snapshot_date having count(*) > 1)")
    + " union all select 'lineitem', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)",
)
def duplicated_key_pairs(x: Inputs) -> DataFrame:
    pairs = {t: profiling.duplicated_key_pairs(x.feed(t), RAW_KEY) for t in RAW_FEEDS}
    pairs["lineitem"] = profiling.duplicated_key_pairs(x.table("lineitem"), LINE_KEY)
    return _stack(pairs)


def _null_counts(columns: list[str], source: str) -> str:
    row = f"count(*) as n_rows, {_sum_if('{c} is null')} as null_rows"
    return O.per_column(columns, row, source)


@query(
    "null_key_counts",
    "\nunion all\n".join(f"select '{t}' as \"table\", q.* from ({_null_counts(RAW_KEY, 'fx_' + t)}) q" for t in RAW_FEEDS),
)
def null_key_counts(x: Inputs) -> DataFrame:
    return _stack({t: profiling.null_counts(x.feed(t), RAW_KEY) for t in RAW_FEEDS})


MISSING = "('', 'unknown', 'n/a', 'na', 'nan', 'null', 'none')"


@query(
    "missing_token_scan",
    "\nunion all\n".join(
        f"select '{t}' as \"table\", q.* from ("
        + O.per_column(COLUMNS[t], _sum_if("{c} is null or lower(trim({c})) in " + MISSING) + " as missing_rows", "fx_" + t)
        + ") q"
        for t in RAW_FEEDS
    ),
)
def missing_token_scan(x: Inputs) -> DataFrame:
    return _stack({t: profiling.missing_tokens(x.feed(t)) for t in RAW_FEEDS})


# Malformed text

@query(
    "malformed_numeric_examples",
    f"""
    select * from (with bad as ({' union all '.join(f"select '{c}' as c, {c} as v from fx_financials where not regexp_matches(trim({c}), '{NUMBER}')" for c in NUMERIC)}),
    counted as (select c, v, count(*) as n from bad group by 1, 2),
    ranked as (select c, v, n, cast(row_number() over (partition by c order by n desc, v) as int) as place from counted),
    names as (select unnest([{', '.join(f"'{c}'" for c in NUMERIC)}]) as c)
    select names.c as "column", (select count(*) from bad where bad.c = names.c) as non_numeric_rows,
      r.v as value, r.n as n_rows, r.place as place
    from names left join (select * from ranked where place <= 5) r on r.c = names.c)
    """,
)
def malformed_numeric_examples(x: Inputs) -> DataFrame:
    return profiling.malformed_number_examples(x.feed("financials"), NUMERIC)


@query(
    "pattern_class_counts",
    O.per_column(
        NUMERIC,
        ", ".join([
            _sum_if(f"regexp_matches(trim({{c}}), '{TRAILING}')") + " as trailing_underscore",
            _sum_if("regexp_matches(trim({c}), '^_+$')") + " as lone_underscore",
            _sum_if("regexp_matches(trim({c}), '^__.*__$')") + " as wrapped_sentinel",
            _sum_if(
                f"not regexp_matches(trim({{c}}), '{NUMBER}') and not regexp_matches(trim({{c}}), '{TRAILING}') "
                "and not regexp_matches(trim({c}), '^_+$') and not regexp_matches(trim({c}), '^__.*__$')"
            ) + " as unexpected_pattern",
        ]),
        "fx_financials",
    ),
)
def pattern_class_counts(x: Inputs) -> DataFrame:
    return profiling.pattern_classes(x.feed("financials"), NUMERIC)


@query(
    "invalid_value_listing",
    r"""
    select Age as value, count(*) as n_rows, cast(contains(Age, '_') as int) as has_marker,
     cast(contains(Age, '_') and not regexp_matches(Age, '^-?\d+_+$') as int) as unexpected_form
    from fx_attributes where not regexp_matches(Age, '^\d+$') group by 1 order by 1
    """,
)
def invalid_value_listing(x: Inputs) -> DataFrame:
    return profiling.invalid_values(x.feed("attributes"), "Age", r"^\d+$", "_", r"^-?\d+_+$")


@query(
    "parse_verification",
    O.per_column(
        NUMERIC,
        "count(*) filter (regexp_matches(trim({c}), '^_+$') or regexp_matches(trim({c}), '^__.*__$')) as sentinel_rows, "
        "count(*) filter (p_{c} is null) as null_after_parsing, "
        "count(*) filter (p_{c} is null and {c} is not null) as present_but_unparsed, "
        "count(*) filter (p_{c} is null) - "
        "count(*) filter (regexp_matches(trim({c}), '^_+$') or regexp_matches(trim({c}), '^__.*__$')) as unexpected_nulls",
        f"(select *, {', '.join(f'{O.number(c)} as p_{c}' for c in NUMERIC)} from fx_financials)",
    ),
)
def parse_verification(x: Inputs) -> DataFrame:
    both = apply_rules(x.feed("financials"), cleaning.NUMBER_RULES, with_raw=True)
    return profiling.parse_verification(both, NUMERIC)


@query(
    "threshold_counts",
    f"""
    select * from (select 'parsed' as "table", {_sum_if('age < 0')} as below_low, {_sum_if('age < 18')} as below_mark,
      {_sum_if('age > 100')} as above_high, {_sum_if('age is null')} as null_rows
      from (select {O.AGE} as age from fx_attributes))
    union all
    select 'cleaned', {_sum_if('age < 0')}, {_sum_if('age < 18')}, {_sum_if('age > 100')}, {_sum_if('age is null')}
    from silver_attributes
    """,
)
def threshold_counts(x: Inputs) -> DataFrame:
    """Ages outside the plausible range before the rule, and none left after it."""
    parsed = apply_rules(x.feed("attributes"), [Rule("Age", "age", cleaning.parse_age)])
    return _stack({
        "parsed": profiling.threshold_counts(parsed, "age", 0, 18, 100),
        "cleaned": profiling.threshold_counts(x.silver_attributes, "age", 0, 18, 100),
    })


# Frequencies and distributions

@query(
    "value_frequencies",
    "\nunion all\n".join(
        f"select '{t}' as \"table\", '{c}' as \"column\", cast({c} as varchar) as value, count(*) as n_rows from {s} group by 3"
        for t, s, columns in [
            ("raw", "fx_attributes", ["Occupation"]),
            ("clean", "silver_attributes", ["occupation"]),
            ("raw financials", "fx_financials", CATEGORIES),
            ("clean financials", "typed_fin", CATEGORIES),
        ]
        for c in columns
    )
    + ' order by "table", "column", n_rows desc, value nulls first',
)
def value_frequencies(x: Inputs) -> DataFrame:
    counts = _stack({
        "raw": profiling.value_frequencies(x.feed("attributes"), ["Occupation"]),
        "clean": profiling.value_frequencies(x.silver_attributes, ["occupation"]),
        "raw financials": profiling.value_frequencies(x.feed("financials"), CATEGORIES),
        "clean financials": profiling.value_frequencies(x.typed_financials, CATEGORIES),
    })
    return profiling.most_frequent_first(counts, "table")


@query(
    "implausible_age_frequencies",
    f"""
    select age, count(*) as n_rows from (select {O.AGE} as age from fx_attributes)
    where age < 0 or age > 100 or age < 18 group by 1 order by 1
    """,
)
def implausible_age_frequencies(x: Inputs) -> DataFrame:
    parsed = apply_rules(x.feed("attributes"), [Rule("Age", "age", cleaning.parse_age)])
    odd = parsed.filter((F.col("age") < 18) | (F.col("age") > 100))
    return odd.groupBy("age").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("age")


@query(
    "numeric_distribution",
    O.per_column(
        COUNTS + MONEY,
        "cast(min({c}) as double) as min, cast(max({c}) as double) as max, "
        + _sum_if("{c} < 0") + " as negative_rows, "
        "cast(quantile_disc({c}, 0.5) as double) as p50, cast(quantile_disc({c}, 0.95) as double) as p95, "
        "cast(quantile_disc({c}, 0.99) as double) as p99",
        "typed_fin",
    ),
)
def numeric_distribution(x: Inputs) -> DataFrame:
    return profiling.numeric_distribution(x.typed_financials, COUNTS + MONEY)


@query(
    "value_gaps",
    "select * from ("
    + "\nunion all\n".join(
        f"""select '{c}' as "column", v as value, n, lag(v) over (order by v) as previous_value,
          v - lag(v) over (order by v) as gap
        from (select cast({c} as double) as v, count(*) as n from typed_fin where {c} is not null group by 1)"""
        for c in COUNTS
    )
    + ") where gap > 1",
)
def value_gaps(x: Inputs) -> DataFrame:
    """Where a column's values stop being dense."""
    counted = ordered.count_values(ordered.unpivot(x.typed_financials, COUNTS, "double"))
    return ordered.value_gaps(counted).filter("gap > 1")


@query(
    "string_profile",
    O.per_column(TEXTS, _sum_if("{c} is null") + " as null_rows, count(distinct {c}) as distinct_values", "fx_financials"),
)
def string_profile(x: Inputs) -> DataFrame:
    return profiling.string_profile(x.feed("financials"), TEXTS)


@query(
    "feature_parse_profile",
    O.per_column(
        CLICK_FEATURES,
        "count(*) filter (trim({c}) <> '' and try_cast(trim({c}) as double) is null) as non_numeric_count, "
        "min(try_cast(trim({c}) as double)) as min, max(try_cast(trim({c}) as double)) as max, "
        "count(*) filter (try_cast(trim({c}) as double) < 0) as negative_count, "
        "count(*) filter (try_cast(trim({c}) as double) = 0) as zero_count, "
        "count(distinct try_cast(trim({c}) as double)) as n_unique, "
        "quantile_disc(try_cast(trim({c}) as double), 0.01) as p01, "
        "quantile_disc(try_cast(trim({c}) as double), 0.5) as median, "
        "quantile_disc(try_cast(trim({c}) as double), 0.99) as p99",
        "fx_clickstream",
    ),
)
def feature_parse_profile(x: Inputs) -> DataFrame:
    return profiling.parse_profile(x.feed("clickstream"), CLICK_FEATURES)


@query(
    "derived_feature_summary",
    O.per_column(
        features.DERIVED_FINANCIALS,
        'count({c}) as "count", round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as stddev, '
        "min({c}) as min, max({c}) as max, quantile_disc({c}, 0.25) as p25, quantile_disc({c}, 0.5) as p50, "
        "quantile_disc({c}, 0.75) as p75",
        "gold_financials",
    ),
)
def derived_feature_summary(x: Inputs) -> DataFrame:
    return profiling.derived_summary(x.gold_financials, features.DERIVED_FINANCIALS)


# Cross-column audits

@query(
    "loan_count_mismatch",
    "select Customer_ID, snapshot_date, Type_of_Loan, Num_of_Loan, loan_type_count from typed_fin "
    "where Num_of_Loan is distinct from loan_type_count",
)
def loan_count_mismatch(x: Inputs) -> DataFrame:
    return audits.loan_count_mismatch(x.typed_financials)


@query(
    "rows_changed_by_rule",
    "\nunion all\n".join(
        f"select '{c}' as \"column\", {_sum_if(f'{c} is distinct from ({O.between(c, low, high)})')} as changed_rows from typed_fin"
        for c, low, high in [
            ("Num_Bank_Accounts", 0, 11), ("Num_Credit_Card", 0, 11), ("Interest_Rate", 0, 34),
            ("Num_of_Delayed_Payment", 0, 28), ("Num_Credit_Inquiries", 0, 17),
        ]
    ),
)
def rows_changed_by_rule(x: Inputs) -> DataFrame:
    both = apply_rules(x.typed_financials, cleaning.RANGE_RULES, with_raw=True)
    return profiling.rows_changed(both, list(cleaning.VALID_RANGES))


INCOME_RATIO = "case when Monthly_Inhand_Salary > 0 then Annual_Income / (Monthly_Inhand_Salary * 12) end"


@query(
    "income_salary_summary",
    O.per_column(
        ["Annual_Income", "Monthly_Inhand_Salary", "annual_income_to_salary_ratio"],
        "min({c}) as min, max({c}) as max, quantile_disc({c}, 0.25) as p25, quantile_disc({c}, 0.5) as p50, "
        "quantile_disc({c}, 0.75) as p75, quantile_disc({c}, 0.95) as p95, quantile_disc({c}, 0.99) as p99",
        f"(select *, {INCOME_RATIO} as annual_income_to_salary_ratio from typed_fin)",
    ),
)
def income_salary_summary(x: Inputs) -> DataFrame:
    return audits.income_salary_summary(x.typed_financials)


@query(
    "income_salary_audit",
    "select Customer_ID, snapshot_date, Annual_Income, Monthly_Inhand_Salary, annual_income_to_salary_ratio "
    f"from (select *, {INCOME_RATIO} as annual_income_to_salary_ratio from typed_fin) "
    "where annual_income_to_salary_ratio > 1.5 order by Annual_Income, Customer_ID, snapshot_date",
)
def income_salary_audit(x: Inputs) -> DataFrame:
    return audits.high_income_ratio(x.typed_financials)


@query(
    "emi_top_k",
    "select Customer_ID, snapshot_date, Num_of_Loan_clean, Total_EMI_per_month, Monthly_Inhand_Salary, "
    "case when Monthly_Inhand_Salary > 0 then Total_EMI_per_month / Monthly_Inhand_Salary end as emi_to_salary_ratio "
    "from checked_fin order by Total_EMI_per_month desc nulls last, Customer_ID, snapshot_date limit 50",
)
def emi_top_k(x: Inputs) -> DataFrame:
    return audits.largest_repayments(x.reconciled)


@query(
    "emi_without_loans",
    "select Customer_ID, snapshot_date, Num_of_Loan_clean, Type_of_Loan, Total_EMI_per_month from checked_fin "
    "where Num_of_Loan_clean = 0 order by Total_EMI_per_month desc, Customer_ID, snapshot_date",
)
def emi_without_loans(x: Inputs) -> DataFrame:
    return audits.without_loans(x.reconciled)


@query(
    "emi_without_loans_count",
    "select count(*) as n_rows from checked_fin where Num_of_Loan_clean = 0 and Total_EMI_per_month > 0",
)
def emi_without_loans_count(x: Inputs) -> DataFrame:
    return audits.repaying_without_loans(x.reconciled)


@query(
    "emi_exceeds_salary",
    "select Customer_ID, snapshot_date, Total_EMI_per_month, Monthly_Inhand_Salary, Num_of_Loan_clean "
    "from checked_fin where Total_EMI_per_month > Monthly_Inhand_Salary",
)
def emi_exceeds_salary(x: Inputs) -> DataFrame:
    return audits.repayment_above_salary(x.reconciled)


WHOLE = "Total_EMI_per_month > 0 and Total_EMI_per_month = floor(Total_EMI_per_month)"
BELOW_ABOVE = (
    f"{_sum_if('Total_EMI_per_month < Monthly_Inhand_Salary')} as emi_below_salary, "
    f"{_sum_if('Total_EMI_per_month > Monthly_Inhand_Salary')} as emi_above_salary"
)


@query("whole_emi_split", f"select Num_of_Loan_clean, {BELOW_ABOVE} from checked_fin where {WHOLE} group by 1 order by 1")
def whole_emi_split(x: Inputs) -> DataFrame:
    return audits.whole_repayment_split(x.reconciled)


@query("whole_emi_totals", f"select {BELOW_ABOVE} from checked_fin where {WHOLE}")
def whole_emi_totals(x: Inputs) -> DataFrame:
    return audits.whole_repayment_totals(x.reconciled)


@query(
    "duration_range",
    f"select min(m) as min_months, max(m) as max_months, {_sum_if('m is null')} as null_months "
    f"from (select {O.MONTHS} as m from fx_financials)",
)
def duration_range(x: Inputs) -> DataFrame:
    return audits.duration_range(x.typed_financials)


# Correlation

PAIRS = [(a, b) for i, a in enumerate(CLICK_FEATURES) for b in CLICK_FEATURES[i + 1:]]


@query(
    "correlation_matrix",
    O.per_column(CLICK_FEATURES, ", ".join(f"round(corr({{c}}, {b}), 4) as {b}" for b in CLICK_FEATURES), "silver_clickstream"),
)
def correlation_matrix(x: Inputs) -> DataFrame:
    return association.correlation_matrix(x.silver_clicks, CLICK_FEATURES)


@query(
    "top_correlations",
    "select col_a, col_b, corr, abs(corr) as abs_corr from (select unnest(["
    + ", ".join(f"{{'col_a': '{a}', 'col_b': '{b}', 'corr': round(corr({a}, {b}), 4)}}" for a, b in PAIRS)
    + "], recursive := true) from silver_clickstream) order by abs(corr) desc, col_a, col_b limit 20",
)
def top_correlations(x: Inputs) -> DataFrame:
    return association.top_correlations(x.silver_clicks, CLICK_FEATURES)


# Tables against each other

SILVER = ["attributes", "financials", "clickstream"]


@query(
    "profile_snapshot_table",
    "\nunion all\n".join(
        f"""select '{t}' as "table", count(*) as total_rows,
          (select count(*) from (select distinct customer_id from silver_{t})) as distinct_customers,
          (select count(*) from (select distinct customer_id, snapshot_date from silver_{t})) as distinct_keys,
          (select count(*) from (select 1 from silver_{t} group by customer_id, snapshot_date having count(*) > 1)) as duplicate_keys,
          min(snapshot_date) as min_snapshot_date, max(snapshot_date) as max_snapshot_date,
          count(distinct snapshot_date) as number_of_snapshots
        from silver_{t}"""
        for t in SILVER
    ),
)
def profile_snapshot_table(x: Inputs) -> DataFrame:
    tables = {"attributes": x.silver_attributes, "financials": x.silver_financials, "clickstream": x.silver_clicks}
    return reduce(DataFrame.unionByName, [profiling.profile_snapshot_table(df, t) for t, df in tables.items()])


@query(
    "null_summary",
    f"""select 'attributes' as "table", q.* from ({_null_counts(['customer_id', 'age', 'occupation', 'snapshot_date'], 'silver_attributes')}) q
    union all select 'feature store', q.* from ({_null_counts(features.ENGINEERED, 'feature_store')}) q""",
)
def null_summary(x: Inputs) -> DataFrame:
    return _stack({
        "attributes": profiling.null_counts(x.silver_attributes),
        "feature store": profiling.null_counts(x.feature_store, features.ENGINEERED),
    })


@query(
    "cleaned_income_nulls",
    f"select count(*) as n_rows, {_sum_if('annual_income is null')} as null_rows, 'annual_income' as \"column\" from silver_financials",
)
def cleaned_income_nulls(x: Inputs) -> DataFrame:
    return profiling.null_counts(x.silver_financials, ["annual_income"])


@query(
    "row_preservation",
    "\nunion all\n".join(
        f"select '{t}' as \"table\", r.snapshot_date, r.n as raw_rows, c.n as clean_rows, cast(r.n = c.n as int) as preserved "
        f"from (select cast(snapshot_date as date) as snapshot_date, count(*) as n from fx_{t} group by 1) r "
        f"join (select snapshot_date, count(*) as n from silver_{s} group by 1) c using (snapshot_date)"
        for t, s in [("loan_daily", "loan"), ("attributes", "attributes"), ("financials", "financials"), ("clickstream", "clickstream")]
    ),
)
def row_preservation(x: Inputs) -> DataFrame:
    """Every month of every feed, landed and cleaned: what the bronze write counted against the silver rows."""
    mart = Mart(x.spark, scratch_path(x.spark, "mart"))
    frames = []
    for t in FEEDS:
        mart.write("bronze", t, x.feed(t), [], gather=True)
        months = snapshots_present(x.spark, mart.path("bronze", t))
        clean(mart, t, months)
        frames.append(profiling.row_preservation(mart.rows("bronze", t, months), mart.silver(t), t))
    return reduce(DataFrame.unionByName, frames)


@query(
    "key_coverage_anti",
    "\nunion all\n".join(
        f"select distinct customer_id, snapshot_date, '{a}' as only_in from silver_{a} l where not exists "
        f"(select 1 from silver_{b} r where r.customer_id = l.customer_id and r.snapshot_date = l.snapshot_date)"
        for a, b in [("attributes", "clickstream"), ("clickstream", "attributes")]
    ),
)
def key_coverage_anti(x: Inputs) -> DataFrame:
    return checks.unmatched_keys(x.silver_attributes, x.silver_clicks, "attributes", "clickstream")


@query(
    "key_coverage_counts",
    """
    select cast((select count(*) from (select distinct customer_id, snapshot_date from silver_attributes) l where not exists
      (select 1 from silver_financials r where r.customer_id = l.customer_id and r.snapshot_date = l.snapshot_date)) as bigint) as only_attributes,
     cast((select count(*) from (select distinct customer_id, snapshot_date from silver_financials) l where not exists
      (select 1 from silver_attributes r where r.customer_id = l.customer_id and r.snapshot_date = l.snapshot_date)) as bigint) as only_financials
    """,
)
def key_coverage_counts(x: Inputs) -> DataFrame:
    lonely = checks.unmatched_keys(x.silver_attributes, x.silver_financials, "attributes", "financials")
    return lonely.agg(
        profiling.rows_where(F.col("only_in") == "attributes").alias("only_attributes"),
        profiling.rows_where(F.col("only_in") == "financials").alias("only_financials"),
    )


@query(
    "coverage_by_snapshot",
    """
    select snapshot_date, count(*) as anchor_rows, count(c.customer_id) as covered_rows,
     count(c.customer_id) / count(*) as coverage_rate
    from (select distinct customer_id, snapshot_date from silver_attributes) a
    left join (select distinct customer_id, snapshot_date from silver_clickstream) c using (customer_id, snapshot_date)
    group by 1 order by 1
    """,
)
def coverage_by_snapshot(x: Inputs) -> DataFrame:
    return profiling.coverage_by_snapshot(x.silver_attributes, x.silver_clicks)


@query(
    "gold_coverage",
    """
    select snapshot_date, count(*) as n_rows, count(distinct customer_id) as customers,
     cast(sum(has_clickstream) as bigint) as rows_with_clickstream,
     cast(sum(has_full_clickstream_3m_history) as bigint) as rows_with_full_3m_history,
     sum(has_clickstream) / count(*) as clickstream_coverage_rate
    from feature_store group by 1 order by 1
    """,
)
def gold_coverage(x: Inputs) -> DataFrame:
    return profiling.gold_coverage(x.feature_store)


@query(
    "history_availability",
    "select snapshot_date, count(*) as n_rows, cast(sum(has_full_clickstream_3m_history) as bigint) as rows_with_full_3m_history "
    "from gold_clickstream group by 1 order by 1",
)
def history_availability(x: Inputs) -> DataFrame:
    return profiling.history_availability(x.gold_clicks)


@query(
    "label_distribution",
    "select label, count(*) as n_rows, count(distinct loan_id) as distinct_loans from labels30 group by 1 order by 1",
)
def label_distribution(x: Inputs) -> DataFrame:
    return profiling.label_distribution(x.labels)


@query("label_profile", "select count(*) as n_rows, count(distinct loan_id) as distinct_loans from labels30")
def label_profile(x: Inputs) -> DataFrame:
    return x.labels.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("loan_id").alias("distinct_loans"))


@query("flag_distribution", "select age_under_18_flag, count(*) as n_rows from gold_attributes group by 1 order by 1")
def flag_distribution(x: Inputs) -> DataFrame:
    counts = x.gold_attributes.groupBy("age_under_18_flag").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy("age_under_18_flag")


@query(
    "under_age_listing",
    "select * from gold_attributes where age_under_18_flag = 1 order by snapshot_date, customer_id",
)
def under_age_listing(x: Inputs) -> DataFrame:
    return x.gold_attributes.filter("age_under_18_flag = 1").orderBy("snapshot_date", "customer_id")


@query("store_duplicate_keys", "select customer_id, snapshot_date, count(*) as n_rows from feature_store group by 1, 2 having count(*) > 1")
def store_duplicate_keys(x: Inputs) -> DataFrame:
    return checks.duplicate_keys(x.feature_store, FEATURE_KEY)
