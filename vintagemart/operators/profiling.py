"""Profiles of whole tables, as typed tables of their own.

Counts and quantiles over many columns are one global aggregate over one scan,
read back as one row per column; nothing is collected.  Where values themselves
are counted (frequencies, examples, distinct values), that is a second scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import is_missing_text
from ..schemas import FEATURE_KEY
from ..sources.scratch import written
from .checks import key_sides, membership, with_membership
from .ordered import GROUP, VALUE, unpivot
from .rules import RAW_PREFIX

# Quantiles are off by about one in so many rows, as with the built-in ones; they are exact for columns
# of up to ``SKETCH_SIZE`` rows.  A sketch of that size holds a megabyte at most, whatever it has seen.
ACCURACY = 10_000
SKETCH_SIZE = 65_535

# Summaries of tasks are merged in so many groups, those in fewer, and so on; no group merges more than
# 32 of the step before, up to a million tasks.
MERGE_GROUPS = (32_768, 1024, 32, 1)

# Repeated row numbers, of 16 bytes, up to which they are sent to all tasks.
BROADCAST_NUMBERS = 1_000_000

# Items a task's summary of frequent values tracks, and candidates it names, per column.
TRACKED, CANDIDATES = 10_000, 100

# Whole numbers smaller than this, by size, are counted by bitmaps: 64 of 4 KB per column at most.
WHOLE = 1 << 20

# The forms numeric text may have.
NUMBER = r"^-?\d+(\.\d+)?$"
NUMBER_THEN_UNDERSCORES = r"^-?\d+(\.\d+)?_+$"
ONLY_UNDERSCORES = r"^_+$"
WRAPPED = r"^__.*__$"

Metric = Callable[[str], Column]


def rows_where(condition: Column) -> Column:
    """Rows for which the condition is true (neither false nor unknown)."""
    return F.count_if(condition)


def per_column(df: DataFrame, columns: Sequence[str], metrics: Mapping[str, Metric]) -> DataFrame:
    """One row per column with the given aggregates, all computed in a single pass."""
    rows = [
        F.struct(F.lit(c).alias(GROUP), *[metric(c).alias(name) for name, metric in metrics.items()])
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


# Keys and duplicates

def _known_or_not(*columns: str) -> Column:
    """A value that counts as distinct even where the columns are NULL."""
    return F.struct(*columns)


def profile_partitions(df: DataFrame, key: str, by: str = "snapshot_date") -> DataFrame:
    """Per snapshot: rows, columns, distinct keys, and whether the key is unique in it."""
    counts = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(_known_or_not(key)).alias("distinct_keys")
    )
    return counts.select(
        by,
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        "distinct_keys",
        (F.col("n_rows") == F.col("distinct_keys")).cast("int").alias("key_is_unique"),
    )


def row_numbers(columns: Sequence[str]) -> list[Column]:
    """Two independent 64-bit numbers of a row, which see NULLs and the order of columns."""
    marked = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*marked).alias("_number"), F.xxhash64(F.lit("second"), *reversed(marked)).alias("_check")]


def exact_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; 0 if there are none.

    Only two numbers of each row are shuffled.  Rows whose numbers occur more than once are compared in
    full, so that equal numbers of different rows count for nothing: their numbers go to the tasks if there are
    few of them, else the rows go to the numbers.
    """
    numbered = df.select(*df.columns, *row_numbers(df.columns))
    seen = numbered.groupBy("_number", "_check").agg(F.count(F.lit(1)).alias("n"))
    repeated = written(seen.where("n > 1").select("_number", "_check"), "repeated_numbers")
    few = repeated.count() <= BROADCAST_NUMBERS
    again = numbered.join(F.broadcast(repeated) if few else repeated, ["_number", "_check"], "left_semi")
    copies = again.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicated_key_pairs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.agg(rows_where(F.col("n_rows") > 1).alias("duplicated_pairs"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and NULLs per column."""
    return per_column(
        df,
        list(columns or df.columns),
        {
            "n_rows": lambda c: F.count(F.lit(1)),
            "null_rows": lambda c: rows_where(F.col(c).isNull()),
        },
    )


def profile_snapshot_table(df: DataFrame, name: str) -> DataFrame:
    """Rows, keys, repeated keys and date range of one feature table."""
    keys = df.groupBy(*FEATURE_KEY).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(
        F.lit(name).alias("table"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_distinct(_known_or_not("customer_id")).alias("distinct_customers"),
        F.count(F.lit(1)).alias("distinct_keys"),
        rows_where(F.col("n") > 1).alias("duplicate_keys"),
        F.min("snapshot_date").alias("min_snapshot_date"),
        F.max("snapshot_date").alias("max_snapshot_date"),
        F.count_distinct("snapshot_date").alias("number_of_snapshots"),
    )


def row_preservation(raw: Mapping[date | None, int], clean: DataFrame, name: str, by: str = "snapshot_date") -> DataFrame:
    """Per month, rows a table had before cleaning, as its write counted them, and after, and whether none was lost.

    Rows whose month became NULL are a month of their own, so they count as lost.
    """
    counted = clean.sparkSession.createDataFrame(list(raw.items()), f"{by} date, raw_rows long")
    found = clean.groupBy(by).agg(F.count(F.lit(1)).alias("clean_rows"))
    both = counted.unionByName(found, allowMissingColumns=True).groupBy(by)
    counts = both.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("raw_rows", "clean_rows")])
    return counts.select(
        F.lit(name).alias("table"), by, "raw_rows", "clean_rows", (F.col("raw_rows") == F.col("clean_rows")).cast("int").alias("preserved")
    )


# Text

def missing_tokens(df: DataFrame) -> DataFrame:
    """Per column: rows that are NULL or spell "no value"."""
    return per_column(
        df, df.columns, {"missing_rows": lambda c: rows_where(is_missing_text(F.col(c)))}
    )


def malformed_numbers(df: DataFrame, columns: Sequence[str], examples: int = 5) -> DataFrame:
    """The most frequent values per column that are not plain numbers, with their frequency."""
    return most_frequent_values(unpivot(df, columns).filter(~F.trim(VALUE).rlike(NUMBER)), examples)


def most_frequent_values(long: DataFrame, most_values: int, tracked: int = TRACKED) -> DataFrame:
    """The most frequent (column, value) rows: (column, value, n_rows, place), ties by value; exact.

    Tasks summarise their values in sketches of ``tracked`` items, which name candidates; a second scan
    counts the candidates.  A value that is no candidate occurs at most so often as the sketch may be off, or
    as the last candidate.  A column whose last wanted value is more frequent than that, or whose
    candidates make up all its rows, is done; the values of any other column are all counted.
    """
    spark = long.sparkSession
    wanted = max(CANDIDATES, most_values)
    sketch_ = F.expr(f"approx_top_k({VALUE}, {wanted}, {max(tracked, wanted)})")
    # One row per column, with a bounded list.
    found = long.groupBy(GROUP).agg(F.count(F.lit(1)).alias("rows"), sketch_.alias("items")).collect()
    named = [(r[GROUP], item["item"]) for r in found for item in r["items"]]
    kinds = f"{GROUP} string, {VALUE} {long.schema[VALUE].dataType.simpleString()}"
    candidates = spark.createDataFrame(named, kinds)
    exact = long.join(F.broadcast(candidates), [GROUP, VALUE]).groupBy(GROUP, VALUE).agg(F.count(F.lit(1)).alias("n_rows"))
    counts = {r[GROUP]: [] for r in found}
    for r in exact.collect() if named else ():
        counts[r[GROUP]].append((r["n_rows"], r[VALUE]))
    proven, open_ = [], []
    for r in found:
        mine = sorted(counts[r[GROUP]], key=lambda c: (-c[0], _in_order(c[1])))
        # Fixed value: a sketch is off by at most 3.5 rows in as many as it tracks, and leaves out what may be
        # nothing but that error.
        missed = 2 * 3.5 * r["rows"] / max(tracked, wanted)
        if len(r["items"]) == wanted:
            missed = max(missed, r["items"][-1]["count"])
        done = sum(n for n, _ in mine) == r["rows"] or (len(mine) >= most_values and mine[most_values - 1][0] > missed)
        if done:
            proven += [(r[GROUP], value, n, place) for place, (n, value) in enumerate(mine[:most_values], 1)]
        else:
            open_.append(r[GROUP])
    shown = spark.createDataFrame(proven, f"{kinds}, n_rows long, place int")
    return shown.unionByName(_counted_in_full(long.where(F.col(GROUP).isin(open_)), most_values)) if open_ else shown


def _in_order(value):
    """As Spark orders: text by its bytes."""
    return value.encode() if isinstance(value, str) else value


def _counted_in_full(long: DataFrame, most_values: int) -> DataFrame:
    """The same by counting every value; the rank limit is applied in every task before rows are brought together."""
    counts = long.groupBy(GROUP, VALUE).agg(F.count(F.lit(1)).alias("n_rows"))
    place = F.row_number().over(Window.partitionBy(GROUP).orderBy(F.desc("n_rows"), VALUE))
    return counts.select("*", place.alias("place")).filter(F.col("place") <= most_values)


def malformed_number_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column that hold text which is not a plain number."""
    return per_column(
        df, columns, {"non_numeric_rows": lambda c: rows_where(~F.trim(c).rlike(NUMBER))}
    )


def malformed_number_examples(df: DataFrame, columns: Sequence[str], examples: int = 5) -> DataFrame:
    """Both of the above side by side; a clean column has one row without an example."""
    ranked = malformed_numbers(df, columns, examples)
    # One row per column on the left, a few per column on the right: both bounded.
    return malformed_number_rows(df, columns).join(F.broadcast(ranked), GROUP, "left")


def pattern_classes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows in each known malformed form, and in none of the known forms.

    A value is put into one class, by the first form it has, and the classes are counted.
    """
    forms = {"number": NUMBER, "trailing_underscore": NUMBER_THEN_UNDERSCORES, "lone_underscore": ONLY_UNDERSCORES, "wrapped_sentinel": WRAPPED}

    def form(c: str) -> Column:
        text = F.trim(c)
        found = F.when(text.isNotNull(), "unexpected_pattern")
        for name, pattern in reversed(forms.items()):
            found = F.when(text.rlike(pattern), name).otherwise(found)
        return found.alias(c)

    classes = [*list(forms)[1:], "unexpected_pattern"]
    classed = df.select(*[form(c) for c in columns])
    return per_column(classed, columns, {name: lambda c, name=name: rows_where(F.col(c) == name) for name in classes})


def invalid_values(df: DataFrame, column: str, valid: str, marker: str, expected: str) -> DataFrame:
    """Distinct values that do not match ``valid``, in order, with their rows.

    Also says whether the value contains the marker, and whether it then has the
    form expected of such values.
    """
    value = F.col(column)
    return (
        df.filter(~value.rlike(valid))
        .groupBy(value.alias(VALUE))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            VALUE,
            "n_rows",
            F.col(VALUE).contains(marker).cast("int").alias("has_marker"),
            (F.col(VALUE).contains(marker) & ~F.col(VALUE).rlike(expected)).cast("int").alias("unexpected_form"),
        )
        .orderBy(VALUE)
    )


def string_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL rows and distinct values per text column.

    Values are counted once per (column, value), so the distinct count needs no
    set per column.
    """
    counts = unpivot(df, columns).groupBy(GROUP, VALUE).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(GROUP).agg(
        F.coalesce(F.sum(F.when(F.col(VALUE).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count(VALUE).alias("distinct_values"),
    )


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column; NULL is a value."""
    return unpivot(df, columns, "string").groupBy(GROUP, VALUE).agg(F.count(F.lit(1)).alias("n_rows"))


def most_frequent_first(counts: DataFrame, *names: str) -> DataFrame:
    """Frequencies in order: by table and column, then the most frequent value first."""
    return counts.orderBy(*names, GROUP, F.desc("n_rows"), VALUE)


# Cleaning, checked

def parse_verification(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per parsed column beside its raw text: sentinels, NULLs, and NULLs no sentinel explains."""

    def raw(c: str) -> Column:
        return F.trim(RAW_PREFIX + c)

    def sentinel(c: str) -> Column:
        return raw(c).rlike(ONLY_UNDERSCORES) | raw(c).rlike(WRAPPED)

    counts = per_column(
        both,
        columns,
        {
            "sentinel_rows": lambda c: rows_where(sentinel(c)),
            "null_after_parsing": lambda c: rows_where(F.col(c).isNull()),
            "present_but_unparsed": lambda c: rows_where(raw(c).isNotNull() & F.col(c).isNull()),
        },
    )
    return counts.withColumn("unexpected_nulls", F.col("null_after_parsing") - F.col("sentinel_rows"))


def threshold_counts(df: DataFrame, column: str, low: float, mark: float, high: float) -> DataFrame:
    """Rows below ``low``, below ``mark`` and above ``high``, and NULL rows."""
    value = F.col(column)
    return df.agg(
        rows_where(value < low).alias("below_low"),
        rows_where(value < mark).alias("below_mark"),
        rows_where(value > high).alias("above_high"),
        rows_where(value.isNull()).alias("null_rows"),
    )


def rows_changed(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows whose cleaned value differs from the one beside it, NULLs compared as values."""
    return per_column(
        both,
        columns,
        {"changed_rows": lambda c: rows_where(~F.col(c).eqNullSafe(F.col(RAW_PREFIX + c)))},
    )


# Numbers

class Merged(NamedTuple):
    """A metric in steps: of the rows of a task, of several such parts, and what is shown of it."""

    part: Metric
    whole: Callable[[Column], Column]
    shown: Callable[[Column], Column] = lambda found: found


def least(value: Metric) -> Merged:
    return Merged(lambda c: F.min(value(c)), F.min)


def most(value: Metric) -> Merged:
    return Merged(lambda c: F.max(value(c)), F.max)


def rows_with(condition: Metric) -> Merged:
    return Merged(lambda c: rows_where(condition(c)), F.sum)


def moments(shown: Callable[[Column], Column]) -> Merged:
    """Number, mean and sum of squared deviations, of which ``shown`` makes the metric."""

    def part(c: str) -> Column:
        mean, deviation = F.coalesce(F.avg(c), F.lit(0.0)), F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0))
        return F.struct(F.count(c).cast("double").alias("n"), mean.alias("mean"), deviation.alias("m2"))

    def both(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        share = F.when(n > 0, b["n"] / n).otherwise(0.0)
        return F.struct(
            n.alias("n"), (a["mean"] + apart * share).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2")
        )

    nothing = F.struct(*[F.lit(0.0).alias(name) for name in ("n", "mean", "m2")])
    return Merged(part, lambda found: F.reduce(F.collect_list(found), nothing, both), shown)


def sketch(value: Metric, accuracy: int = ACCURACY) -> Merged:
    """A sketch of a column's numbers; NaN is not a number."""
    size = min(65_535, max(8, round(SKETCH_SIZE * accuracy / ACCURACY)))
    return Merged(lambda c: F.kll_sketch_agg_double(value(c).cast("double"), size), F.kll_merge_agg_double)


def quantile(found: Column, share: float) -> Column:
    """A discrete quantile of a sketch; NULL where it has seen no number."""
    return F.when(F.kll_sketch_get_n_double(found) > 0, F.kll_sketch_get_quantile_double(found, F.lit(share)))


def per_column_with_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    metrics: Mapping[str, Merged],
    probabilities: Mapping[str, float],
    value: Metric = F.col,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per column with the given metrics and named quantiles, in a single pass.

    A task makes one summary of all columns.  Summaries are merged in a tree, column by column,
    so that the last step has a few of them, however many tasks there were.
    """
    steps = {**metrics, "sketch": sketch(value, accuracy)}
    rows = F.array(*[F.struct(F.lit(c).alias(GROUP), *[m.part(c).alias(name) for name, m in steps.items()]) for c in columns])
    first, *later = MERGE_GROUPS
    tasks = df.withColumn("_task", F.spark_partition_id() % first).groupBy("_task").agg(rows.alias("rows"))
    # A table without rows has its summaries too.
    tasks = tasks.unionByName(df.where(F.lit(False)).agg(rows.alias("rows")).withColumn("_task", F.lit(0)))
    parts = tasks.select("_task", F.inline("rows"))
    for groups in later:
        merged = [m.whole(F.col(name)).alias(name) for name, m in steps.items()]
        parts = parts.groupBy(GROUP, (F.col("_task") % groups).alias("_task")).agg(*merged)
    return parts.select(
        GROUP,
        *[m.shown(F.col(name)).alias(name) for name, m in metrics.items()],
        *[quantile(F.col("sketch"), share).alias(name) for name, share in probabilities.items()],
    )


def value_spread(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """Minimum, the given quantiles, maximum and negative rows per column."""
    return per_column_with_quantiles(
        df,
        columns,
        {
            "min": least(lambda c: F.col(c).cast("double")),
            "max": most(lambda c: F.col(c).cast("double")),
            "negative_rows": rows_with(lambda c: F.col(c) < 0),
        },
        probabilities,
    )


def numeric_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return value_spread(df, columns, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def parse_profile(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How text columns read as numbers: unreadable rows, distribution, signs, distinct values."""

    def number(c: str) -> Column:
        return F.trim(c).try_cast("double")

    shape = per_column_with_quantiles(
        raw,
        columns,
        {
            "non_numeric_count": rows_with(lambda c: (F.trim(c) != "") & number(c).isNull()),
            "min": least(number),
            "max": most(number),
            "negative_count": rows_with(lambda c: number(c) < 0),
            "zero_count": rows_with(lambda c: number(c) == 0),
        },
        {"p01": 0.01, "median": 0.5, "p99": 0.99},
        number,
    )
    distinct = distinct_numbers(unpivot(raw, columns).select(GROUP, F.trim(VALUE).try_cast("double").alias(VALUE)))
    # One row per column on either side.
    return shape.join(F.broadcast(distinct), GROUP, "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0)))


def distinct_numbers(long: DataFrame) -> DataFrame:
    """Distinct numbers per column of (column, value) rows: (column, n_unique), exact.

    Whole numbers below ``WHOLE`` are bits of a few bitmaps per column, which tasks combine before anything
    is shuffled, however many rows and values there are.  Only other numbers are shuffled by value.
    """
    whole = (F.col(VALUE) == F.floor(VALUE)) & (F.abs(VALUE) < WHOLE)
    known = long.where(F.col(VALUE).isNotNull())
    bit = known.where(whole).select(GROUP, (F.floor(VALUE) + WHOLE).alias("bit"))
    maps = bit.groupBy(GROUP, F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    counted = maps.groupBy(GROUP).agg(F.sum(F.bitmap_count("bits")).alias("n"))
    others = known.where(~whole).distinct().groupBy(GROUP).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(others).groupBy(GROUP).agg(F.sum("n").alias("n_unique"))


def derived_summary(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles per column.

    Mean and deviation are rounded, as their last digits depend on the order of addition.
    """
    return per_column_with_quantiles(
        df,
        columns,
        {
            "count": rows_with(lambda c: F.col(c).isNotNull()),
            "mean": moments(lambda m: F.when(m["n"] > 0, F.round(m["mean"], digits))),
            "stddev": moments(lambda m: F.when(m["n"] > 1, F.round(F.sqrt(m["m2"] / (m["n"] - 1)), digits))),
            "min": least(F.col),
            "max": most(F.col),
        },
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
    )


# Coverage

def coverage_by_snapshot(anchor: DataFrame, other: DataFrame) -> DataFrame:
    """Per snapshot: distinct anchor keys, those the other table holds, and their share.

    Of the other table, which may be far larger, only keys that may be the anchor's leave the tasks that read them.
    """
    wanted = with_membership(other.select(*FEATURE_KEY), membership(anchor)).filter("may_match")
    sides = key_sides({"anchor": anchor, "other": wanted}).filter("anchor = 1")
    counts = sides.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("anchor_rows"), F.sum("other").alias("covered_rows")
    )
    rate = F.col("covered_rows") / F.col("anchor_rows")
    return counts.select("*", rate.alias("coverage_rate")).orderBy("snapshot_date")


def gold_coverage(store: DataFrame) -> DataFrame:
    """Per snapshot of the feature store: rows, customers and clickstream coverage."""
    counts = store.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("has_clickstream").alias("rows_with_clickstream"),
        F.sum("has_full_clickstream_3m_history").alias("rows_with_full_3m_history"),
    )
    rate = F.col("rows_with_clickstream") / F.col("n_rows")
    return counts.select("*", rate.alias("clickstream_coverage_rate")).orderBy("snapshot_date")


def history_availability(gold_clicks: DataFrame) -> DataFrame:
    return (
        gold_clicks.groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("has_full_clickstream_3m_history").alias("rows_with_full_3m_history"),
        )
        .orderBy("snapshot_date")
    )


def label_distribution(labels: DataFrame) -> DataFrame:
    """Rows and distinct loans per label."""
    return (
        labels.groupBy("label")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("loan_id").alias("distinct_loans"))
        .orderBy("label")
    )
