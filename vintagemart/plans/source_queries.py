"""Sources, sinks, calendar, slices and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType

from ..operators import checks
from ..schemas import ATTRIBUTES, CLICKSTREAM, FEEDS, FINANCIALS, LEDGER
from ..sources import snapshots as S
from ..sources.calendar import month_spine, months_between, slice_months, spine_of, trailing_months
from ..sources.scratch import scratch_path
from .backfill import Mart, backfill_features, backfill_labels, land_snapshot
from .inputs import Inputs
from .registry import query

# The months the label and the feature backfill cover.
START = "2023-01-01"
LABEL_END = "2024-12-01"
FEATURE_END = "2025-01-01"


def _csv(x: Inputs, feed: str) -> str:
    """The feed as a CSV source in a fresh folder; whole numbers are written with a decimal point."""
    path = scratch_path(x.spark, f"{feed}-csv")
    df = x.feed(feed)
    points = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, IntegerType)}
    S.write_feed(df.withColumns(points) if points else df, path)
    return path


def _stored(x: Inputs, df: DataFrame, name: str) -> str:
    """The rows as a snapshot table in a fresh folder."""
    path = scratch_path(x.spark, name)
    S.write_snapshots(df, path, gather=True)
    return path


@query("ingest_loan_daily", "select * from fx_loan_daily")
def ingest_loan_daily(x: Inputs) -> DataFrame:
    return S.read_feed(x.spark, _csv(x, "loan_daily"), LEDGER)


@query("ingest_feature_raw", "select * from fx_financials")
def ingest_feature_raw(x: Inputs) -> DataFrame:
    return S.read_feed(x.spark, _csv(x, "financials"), FINANCIALS)


@query("read_snapshot", "select * from silver_attributes where snapshot_date = date '2023-05-01'")
def read_snapshot(x: Inputs) -> DataFrame:
    df = x.silver_attributes
    return S.read_snapshot(x.spark, _stored(x, df, "attributes"), df.schema, "2023-05-01")


@query("read_all_snapshots", "select * from silver_financials")
def read_all_snapshots(x: Inputs) -> DataFrame:
    df = x.silver_financials
    return S.read_snapshots(x.spark, _stored(x, df, "financials"), df.schema)


@query(
    "read_history_window",
    "select * from silver_clickstream where snapshot_date in (date '2022-12-01', date '2023-01-01', date '2023-02-01')",
)
def read_history_window(x: Inputs) -> DataFrame:
    """The months up to February 2023, of which December 2022 does not exist."""
    df = x.silver_clicks
    return S.read_snapshots(x.spark, _stored(x, df, "clicks"), df.schema, trailing_months("2023-02-01"))


@query("bronze_roundtrip", "select * from fx_attributes")
def bronze_roundtrip(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "bronze")
    S.write_snapshots(x.feed("attributes"), path, fmt="csv", gather=True)
    return S.read_snapshots(x.spark, path, ATTRIBUTES, fmt="csv")


@query("overwrite_snapshot", "select * from silver_attributes")
def overwrite_snapshot(x: Inputs) -> DataFrame:
    """One month is first written wrong, then written again; the others must survive."""
    right = x.silver_attributes
    month = F.col("snapshot_date") == F.lit("2023-03-01").cast("date")
    wrong = right.withColumn("age", F.when(month, -1).otherwise(F.col("age")))
    path = _stored(x, wrong, "overwritten")
    S.write_snapshots(right.filter(month), path, ["2023-03-01"])
    return S.read_snapshots(x.spark, path, right.schema)


@query("union_snapshots", "select * from fx_clickstream")
def union_snapshots(x: Inputs) -> DataFrame:
    """Every month read by itself, every other one with its columns reversed."""
    path = _stored(x, x.feed("clickstream"), "clicks-raw")
    parts = []
    for i, month in enumerate(S.snapshots_present(x.spark, path)):
        part = S.read_snapshot(x.spark, path, CLICKSTREAM, month)
        parts.append(part.select(*reversed(part.columns)) if i % 2 else part)
    return S.union_snapshots(parts)


@query(
    "missing_snapshots",
    """
    select t."table", s.snapshot_date from (values ('loan_daily'),('attributes'),('financials'),('clickstream')) t("table"),
     (select cast(m as date) as snapshot_date
      from (select unnest(generate_series(date_trunc('month', min(loan_start_date)), max(snapshot_date) + interval 3 month, interval 1 month)) as m
            from fx_loan_daily)) s
    where not exists (select 1 from (
       select 'loan_daily' as "table", snapshot_date from fx_loan_daily
       union all select 'attributes', snapshot_date from silver_attributes
       union all select 'financials', snapshot_date from silver_financials
       union all select 'clickstream', snapshot_date from silver_clickstream) p
      where p."table" = t."table" and p.snapshot_date = s.snapshot_date)
    """,
)
def missing_snapshots(x: Inputs) -> DataFrame:
    """From the first loan to three months past the last ledger month."""
    loans = x.feed("loan_daily")
    bounds = loans.agg(F.min("loan_start_date").alias("a"), F.add_months(F.max("snapshot_date"), 3).alias("b"))
    spine = bounds.select(month_spine(F.col("a"), F.col("b")).alias("snapshot_date"))
    tables = {
        "loan_daily": loans,
        "attributes": x.silver_attributes,
        "financials": x.silver_financials,
        "clickstream": x.silver_clicks,
    }
    return checks.missing_snapshots(spine, tables)


@query(
    "empty_snapshot_skip",
    "select snapshot_date, count(*) as n_rows from silver_clickstream group by 1",
)
def empty_snapshot_skip(x: Inputs) -> DataFrame:
    """A month without rows writes nothing, and an older snapshot of it stays."""
    df = x.silver_clicks
    path = _stored(x, df, "clicks")
    S.write_snapshots(df.filter(F.lit(False)), path, ["2024-01-01"])
    return S.read_snapshots(x.spark, path, df.schema).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "month_spine",
    """
    select cast(unnest(generate_series(date_trunc('month', min(snapshot_date)), max(snapshot_date), interval 1 month)) as date)
      as snapshot_date from fx_loan_daily
    """,
)
def spine(x: Inputs) -> DataFrame:
    return spine_of(x.feed("loan_daily"))


@query("slice_ledger", "select * from fx_loan_daily where snapshot_date = date '2023-07-01'")
def slice_ledger(x: Inputs) -> DataFrame:
    return slice_months(x.feed("loan_daily"), ["2023-07-01"])


@query("slice_feature", "select * from fx_financials where snapshot_date = '2024-02-01'")
def slice_feature(x: Inputs) -> DataFrame:
    return slice_months(x.feed("financials"), ["2024-02-01"])


@query(
    "backfill_labels",
    "select * from labels30 where snapshot_date between date '2023-01-01' and date '2024-12-01'",
)
def labels_backfill(x: Inputs) -> DataFrame:
    mart = Mart(x.spark, scratch_path(x.spark, "mart"))
    return backfill_labels(mart, _csv(x, "loan_daily"), START, LABEL_END)


@query(
    "backfill_features",
    "select * from feature_store where snapshot_date between date '2023-01-01' and date '2025-01-01'",
)
def features_backfill(x: Inputs) -> DataFrame:
    mart = Mart(x.spark, scratch_path(x.spark, "mart"))
    sources = {feed: _csv(x, feed) for feed in FEEDS if feed != "loan_daily"}
    return backfill_features(mart, sources, START, FEATURE_END)


@query("bronze_single_snapshot", "select * from fx_loan_daily where snapshot_date = date '2023-04-01'")
def bronze_single_snapshot(x: Inputs) -> DataFrame:
    mart = Mart(x.spark, scratch_path(x.spark, "mart"), bronze_format="csv")
    land_snapshot(mart, "loan_daily", _csv(x, "loan_daily"), "2023-04-01")
    return mart.bronze("loan_daily", months_between("2023-04-01", "2023-04-01"))
