"""Building the data mart for a range of months.

Each layer of a feed is one job over all months of the run: one scan of the
source, a projection, and one partitioned write.  Layers hand over through
tables, so a lost executor costs its tasks only and any layer can be re-run.
An incremental run is the same call with a shorter range.

Every layer is staged, audited and then published.  A failed audit publishes
nothing, so what readers see is always what passed; the months of a layer
become visible together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import checks, cleaning, features, labels, ledger
from ..schemas import FEEDS
from ..sources.calendar import day_of, months_between, slice_months, trailing_months
from ..sources.snapshots import (
    PARTITION,
    Buckets,
    Staged,
    Written,
    discard_staged,
    publish,
    read_feed,
    read_snapshots,
    rows_by_month,
    snapshots_present,
    stage_snapshots,
)

SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "loan_daily": ledger.silver_loan_daily,
    "attributes": cleaning.silver_attributes,
    "financials": cleaning.silver_financials,
    "clickstream": cleaning.silver_clickstream,
}

# Key of the feature tables' buckets.
CUSTOMER = "customer_id"

# Rows of up to so many months are brought together when they land; those of more months, which may be all rows of
# a feed, are not shuffled for that.
GATHERED_MONTHS = 3

# Feeds without which a month of the feature store cannot be built.
REQUIRED = ("attributes", "financials")


@dataclass
class Mart:
    """A data mart below one folder, and what this object has written to it.

    With ``buckets`` the silver feature tables lie in so many buckets of customers.  Windows and aggregates over
    them need no exchange; nor do the joins of the feature store, in a session that allows tables dealt by a part of
    the key to be joined as they are (``spark.sql.requireAllClusterKeysForCoPartition`` set to false).
    """

    spark: SparkSession
    root: str
    bronze_format: str = "parquet"
    buckets: int | None = None
    written: dict[str, Written] = field(default_factory=dict)
    schemas: dict[str, StructType] = field(default_factory=dict, repr=False)
    # Per feed, source rows that belong to no month; of the last store, its coverage totals.
    unplaced: dict[str, dict[str, int]] = field(default_factory=dict)
    coverage: dict[str, int] = field(default_factory=dict)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        months,
        *,
        fmt: str = "parquet",
        gather: bool = False,
        buckets: Buckets | None = None,
        audit: Callable[[Staged], None] | None = None,
    ) -> Written:
        """Stage the rows, audit what was staged, and publish it; a failed audit leaves the table as it was."""
        staged = stage_snapshots(df, self.path(layer, table), months, fmt=fmt, gather=gather, buckets=buckets)
        if audit is not None:
            try:
                audit(staged)
            except Exception:
                discard_staged(self.spark, staged)
                raise
        done = publish(self.spark, staged)
        self.written[f"{layer}/{table}"] = done
        self.schemas[f"{layer}/{table}"] = df.schema
        return done

    def rows(self, layer: str, table: str, months) -> dict[date | None, int]:
        """Rows of the given months, as counted by those who wrote them."""
        found = rows_by_month(self.spark, self.path(layer, table))
        return {m: found[m] for m in months if m in found}

    def _read(self, layer: str, table: str, months) -> DataFrame:
        name = f"{layer}/{table}"
        if name not in self.schemas:
            self.schemas[name] = derived_schema(self.spark, layer, table)
        return read_snapshots(self.spark, self.path(layer, table), self.schemas[name], months)

    def bronze(self, table: str, months=None) -> DataFrame:
        path = self.path("bronze", table)
        return read_snapshots(self.spark, path, FEEDS[table], months, fmt=self.bronze_format)

    def silver(self, table: str, months=None) -> DataFrame:
        return self._read("silver", table, months)

    def label_store(self, months=None) -> DataFrame:
        return self._read("gold", "label_store", months)

    def feature_store(self, months=None) -> DataFrame:
        return self._read("gold", "feature_store", months)


def derived_schema(spark: SparkSession, layer: str, table: str) -> StructType:
    """The schema of a table, from the operators that build it applied to no rows."""

    def silver(feed: str) -> DataFrame:
        return SILVER[feed](spark.createDataFrame([], FEEDS[feed]))

    if layer == "silver":
        return silver(table).schema
    if table == "label_store":
        return labels.label_store(silver("loan_daily")).schema
    return features.feature_store(silver("attributes"), silver("financials"), silver("clickstream")).schema


def land(mart: Mart, table: str, source: str, months: list[date]) -> Written:
    """Bronze: the rows of the given months, laid out by month; only their month text is trimmed.

    Rows of the source that belong to no month of any run, because their date is
    unreadable or not the first of a month, are counted in ``mart.unplaced``.  Rows of many months
    are written by the tasks that read them, which are no more than a shuffle would have: so many files has a month at most.
    """
    raw = read_feed(mart.spark, source, FEEDS[table])
    day, seen = day_of(raw), Observation()
    counted = raw.observe(
        seen,
        F.count_if(day.isNull()).alias("unreadable"),
        F.count_if(day != F.trunc(day, "month")).alias("off_month"),
    )
    kept = slice_months(counted, months)
    kept = kept.withColumn(PARTITION, day.cast(kept.schema[PARTITION].dataType))
    few = len(months) <= GATHERED_MONTHS
    if not few:
        kept = kept.coalesce(int(mart.spark.conf.get("spark.sql.shuffle.partitions")))
    done = mart.write("bronze", table, kept, months, fmt=mart.bronze_format, gather=few)
    mart.unplaced[table] = dict(seen.get)
    return done


def land_snapshot(mart: Mart, table: str, source: str, month: str | date) -> Written:
    """Bronze for a single month."""
    return land(mart, table, source, months_between(month, month))


def clean(mart: Mart, table: str, months: list[date]) -> Written:
    """Silver: every bronze row of the given months, typed and cleaned.

    Before it is shown, every month must have the rows of its bronze snapshot,
    whoever landed that, and feature tables must have their grain.  The rows were counted
    by the two writes; only the keys of what was staged are read again.
    """
    landed = mart.rows("bronze", table, months)

    def audit(staged: Staged) -> None:
        checks.require_row_parity(landed, staged.rows_by_month, f"silver {table}")
        if table != "loan_daily" and staged.shown:
            checks.require_unique(staged.rows(mart.spark), f"silver {table}")

    buckets = Buckets(CUSTOMER, mart.buckets) if mart.buckets and table != "loan_daily" else None
    return mart.write("silver", table, SILVER[table](mart.bronze(table, months)), months, buckets=buckets, audit=audit)


def backfill_labels(
    mart: Mart,
    source: str,
    start: str | date,
    end: str | date,
    days_past_due: int = labels.DEFAULT_DAYS_PAST_DUE,
    month_on_book: int = labels.DEFAULT_MONTH_ON_BOOK,
) -> DataFrame:
    """Bronze, silver and gold of the loan ledger; returns the label store of these months."""
    months = months_between(start, end)
    land(mart, "loan_daily", source, months)
    clean(mart, "loan_daily", months)
    store = labels.label_store(mart.silver("loan_daily", months), days_past_due, month_on_book)
    mart.write("gold", "label_store", store, months, gather=True)
    return mart.label_store(months)


def assembled(mart: Mart, months: list[date]) -> DataFrame:
    """The feature store of the given months, from the silver tables."""
    history = sorted({m for month in months for m in trailing_months(month)})
    silver = [mart.silver(table, wanted) for table, wanted in (("attributes", months), ("financials", months), ("clickstream", history))]
    return features.feature_store(*silver)


def build_feature_store(mart: Mart, months: list[date]) -> Written:
    """Gold features of the given months from the silver tables.

    Attributes and financials must have every month.  Clickstream may lack any:
    its features are then NULL, and months before the range that exist are read
    as history.  The silver tables have their grain, which was proved before they
    were published, and the joins are on unique keys; so the store must have the rows of
    its anchor, by the counts of the two writes, before it is published.
    """
    for table in REQUIRED:
        present = snapshots_present(mart.spark, mart.path("silver", table))
        checks.require_snapshots(present, months, f"silver {table}")
    store = assembled(mart, months)
    # Coverage is counted by the job that writes.
    seen = Observation()
    store = store.observe(seen, *[F.coalesce(F.sum(flag), F.lit(0)).alias(name) for flag, name in features.COVERAGE_TOTALS.items()])
    anchor = mart.rows("silver", "attributes", months)
    done = mart.write(
        "gold", "feature_store", store, months, gather=True,
        audit=lambda staged: checks.require_row_parity(anchor, staged.rows_by_month, "feature store"),
    )
    mart.coverage = dict(seen.get)
    return done


def backfill_features(
    mart: Mart, sources: Mapping[str, str], start: str | date, end: str | date
) -> DataFrame:
    """All layers of the three feature feeds; returns the feature store of these months."""
    months = months_between(start, end)
    for table, source in sources.items():
        land(mart, table, source, months)
        clean(mart, table, months)
    build_feature_store(mart, months)
    return mart.feature_store(months)
