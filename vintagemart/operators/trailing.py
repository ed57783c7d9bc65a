"""Trailing three-month means of behaviour, never looking past the snapshot.

Two forms give the same numbers:

* ``trailing_window`` answers for every row of the table: a value-range window
  over month numbers.
* ``trailing_for`` answers for a given set of keys: each key is expanded to the
  months it looks back on and met with the table by an equi-join.  Assembling
  the store uses this form, because the cohort needs few of the rows.

The table has one row per customer and month.  That is proved where it is written
(``checks.require_unique``); both forms also fail on a repeated key, without an
exchange of their own: the window by the number of its rows in a month, the
equi-join by the number of rows a key met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import month_number, only_if
from ..schemas import CLICK_FEATURES, CLICK_MEANS, FEATURE_KEY
from ..sources.calendar import TRAILING_MONTHS

RAW_MEANS = [f"{mean}_raw" for mean in CLICK_MEANS]
REPEATED = "clickstream: repeated (customer_id, snapshot_date) key"
REPEATED_KEYS = "cohort: repeated (customer_id, snapshot_date) key"


def trailing_window(clicks: DataFrame) -> DataFrame:
    """Every row with its months of history and its ungated trailing means.

    One exchange, by customer.  A window group is as long as a customer's history;
    a repeated key makes the frame of its own month longer than one row and fails.
    """
    monthly = clicks.withColumn("month_number", month_number(F.col("snapshot_date")))
    months = Window.partitionBy("customer_id").orderBy("month_number")
    span = months.rangeBetween(1 - TRAILING_MONTHS, Window.currentRow)
    unique = F.count(F.lit(1)).over(months.rangeBetween(Window.currentRow, Window.currentRow)) == 1
    return monthly.select(
        *FEATURE_KEY,
        only_if(unique, REPEATED, F.lit(1)).alias("has_clickstream"),
        *CLICK_FEATURES,
        F.count(F.lit(1)).over(span).alias("history_months"),
        *[F.avg(name).over(span).alias(raw) for name, raw in zip(CLICK_FEATURES, RAW_MEANS)],
        # A filter, because a column that nobody reads is never computed.
    ).filter("has_clickstream = 1")


def trailing_for(keys: DataFrame, clicks: DataFrame) -> DataFrame:
    """The same columns for the given keys that have a current row.

    The table crosses the network once, by (customer, month).  The aggregate is a
    hash aggregate over flat columns, combined before it is shuffled, and its
    result comes out partitioned by the full key, ready to be joined to the cohort.
    """
    backs = range(TRAILING_MONTHS)
    # Cohort rows of a key are one row here, with their number, so that either side can be told apart.
    counted = keys.groupBy(*FEATURE_KEY).agg(F.count(F.lit(1)).alias("copies"))
    lookback = counted.select(
        *FEATURE_KEY, "copies", F.explode(F.array(*[F.lit(back) for back in backs])).alias("back")
    ).withColumn("month", F.add_months("snapshot_date", -F.col("back")))
    history = clicks.select("customer_id", F.col("snapshot_date").alias("month"), *CLICK_FEATURES)
    now = F.col("back") == 0
    met = [F.count_if(F.col("back") == back).alias(f"met_{back}") for back in backs]
    found = lookback.join(history, ["customer_id", "month"]).groupBy(*FEATURE_KEY).agg(
        F.max("copies").alias("copies"),
        *met,
        *[F.max(F.when(now, F.col(name))).alias(name) for name in CLICK_FEATURES],
        *[F.avg(name).alias(raw) for name, raw in zip(CLICK_FEATURES, RAW_MEANS)],
    )
    most = F.greatest(*[F.col(f"met_{back}") for back in backs])
    present = sum((F.col(f"met_{back}") > 0).cast("bigint") for back in backs)
    found = found.withColumn("most", most)
    current = (F.col("met_0") > 0).cast("int")
    checked = only_if(F.col("copies") == 1, REPEATED_KEYS, only_if(F.col("most") == 1, REPEATED, current))
    return found.select(
        *FEATURE_KEY,
        checked.alias("has_clickstream"),
        *CLICK_FEATURES,
        present.alias("history_months"),
        *RAW_MEANS,
    ).filter("has_clickstream = 1")


def gate_full_history(trailing: DataFrame) -> DataFrame:
    """Means only where all months are present; a flag says which rows those are."""
    full = F.col("history_months") == TRAILING_MONTHS
    return trailing.select(
        *FEATURE_KEY,
        "has_clickstream",
        full.cast("int").alias("has_full_clickstream_3m_history"),
        *CLICK_FEATURES,
        *[F.when(full, F.col(raw)).alias(mean) for raw, mean in zip(RAW_MEANS, CLICK_MEANS)],
    )


def gold_clickstream(clicks: DataFrame) -> DataFrame:
    """Current values, coverage flags and gated means of every clickstream row."""
    return gate_full_history(trailing_window(clicks))
