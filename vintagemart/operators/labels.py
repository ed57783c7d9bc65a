"""Gold label store and its alignment with feature snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# The outcome the label store is built for.
DEFAULT_DAYS_PAST_DUE = 30
DEFAULT_MONTH_ON_BOOK = 6


def label_tag(days_past_due: int, month_on_book: int) -> str:
    return f"{days_past_due}dpd_{month_on_book}mob"


def label_store(
    silver: DataFrame,
    days_past_due: int = DEFAULT_DAYS_PAST_DUE,
    month_on_book: int = DEFAULT_MONTH_ON_BOOK,
) -> DataFrame:
    """One label per loan observed at ``month_on_book``: 1 from ``days_past_due`` on.

    An undefined number of days counts as 0.
    """
    return labels_for_definitions(silver, [(days_past_due, month_on_book)])


def labels_for_definitions(silver: DataFrame, definitions: Sequence[tuple[int, int]]) -> DataFrame:
    """Labels under several (days past due, month on book) definitions in one scan.

    The month filter comes first and reaches the scan; a row is then repeated
    once per definition that observes its month.
    """
    months = sorted({month for _, month in definitions})
    observed = silver.filter(F.col("mob").isin(months))
    # What a month is observed for: a literal list, picked by the month.
    mine = F.lit(None)
    for m in months:
        listed = [F.struct(F.lit(d).alias("d"), F.lit(label_tag(d, m)).alias("label_def")) for d, other in definitions if other == m]
        mine = F.when(F.col("mob") == m, F.array(*listed)).otherwise(mine)
    chosen = observed.select("*", F.inline(mine))
    label = F.when(F.col("dpd") >= F.col("d"), 1).otherwise(0)
    return chosen.select("loan_id", "Customer_ID", label.alias("label"), "label_def", "snapshot_date")


def align_with_features(labels: DataFrame, months_back: int = DEFAULT_MONTH_ON_BOOK) -> DataFrame:
    """Labels keyed like features, with the snapshot whose features may be used for them."""
    return labels.select(
        "loan_id",
        F.trim("Customer_ID").alias("customer_id"),
        "label",
        "label_def",
        F.col("snapshot_date").alias("label_snapshot_date"),
        F.add_months("snapshot_date", -months_back).alias("feature_snapshot_date"),
    )


def label_date_map(aligned: DataFrame) -> DataFrame:
    """Each label month with its feature month, in order."""
    return (
        aligned.select("label_snapshot_date", "feature_snapshot_date")
        .distinct()
        .orderBy("label_snapshot_date")
    )
