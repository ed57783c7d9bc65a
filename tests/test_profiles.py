"""Order statistics, correlation and profiles against plain Python."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagemart.operators import association, ordered, profiling
from vintagemart.operators.rules import Rule, apply_rules
from vintagemart.functions import parse_number


def long(spark, values):
    return spark.createDataFrame([(c, v) for c, vs in values.items() for v in vs], "column string, value double")


@pytest.fixture(scope="module")
def values():
    """A spread column, one where a single value holds a third of the rows, and tiny ones."""
    rng = random.Random(7)
    spread = [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    hot = [42.0] * 1000 + [float(rng.randrange(500)) for _ in range(2000)]
    return {"spread": spread, "hot": hot, "one": [5.0], "two": [1.0, 9.0], "with_null": [None, 3.0, None, 4.0]}


def disc(values, p):
    kept = sorted(v for v in values if v is not None)
    return kept[max(math.ceil(len(kept) * p), 1) - 1]


def test_quantiles_are_exact(spark, values):
    for column, vs in values.items():
        df = spark.createDataFrame([(v,) for v in vs], "v double").repartition(5)
        got = profiling.value_spread(df, ["v"], {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.95, "e": 0.99}).first()
        assert [got[n] for n in "abcde"] == [disc(vs, p) for p in (0.01, 0.25, 0.5, 0.95, 0.99)], column


@pytest.mark.parametrize("range_values", [1, 7, ordered.RANGE_VALUES])
def test_gaps_are_stitched_over_ranges(spark, values, range_values):
    counted = ordered.count_values(long(spark, values))
    gaps = {(r["column"], r["value"]): r.gap for r in ordered.value_gaps(counted, range_values).collect()}
    for column, vs in values.items():
        distinct = sorted({v for v in vs if v is not None})
        assert gaps[(column, distinct[0])] is None
        for low, high in zip(distinct, distinct[1:]):
            assert gaps[(column, high)] == high - low


def jobs_run(spark, build):
    """Spark jobs that building a plan starts."""
    group = f"plan-{id(build)}"
    spark.sparkContext.setJobGroup(group, "")
    df = build()
    found = list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return df, found


def test_building_a_profile_runs_nothing_and_scans_once(spark, small):
    from vintagemart.plans.inputs import Inputs

    x = Inputs(spark, small)
    builds = {
        "spread": lambda: profiling.numeric_distribution(x.typed_financials, ["Annual_Income", "Num_of_Loan"]),
        "derived": lambda: profiling.derived_summary(x.gold_financials, ["income_after_emi"]),
        "correlation": lambda: association.correlation_matrix(x.silver_clicks, ["fe_1", "fe_2", "fe_4"]),
    }
    x.typed_financials, x.gold_financials, x.silver_clicks
    for name, build in builds.items():
        df, jobs = jobs_run(spark, build)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert jobs == [], name
        assert plan.count("FileScan") == 1, name
        assert plan.count("MapInArrow") <= 1, name


def test_correlation_equals_pandas(spark):
    rng = random.Random(3)
    pdf = pd.DataFrame({"a": [rng.randrange(-50, 50) for _ in range(400)]})
    pdf["b"] = [v * 3 + rng.randrange(10) for v in pdf["a"]]
    pdf["c"] = [None if i % 7 == 0 else rng.randrange(9) for i in range(400)]
    pdf["big"] = [10**9 + v for v in pdf["a"]]
    pdf["constant"] = 7
    pdf["mostly"] = [1 if i % 7 else 2 for i in range(400)]  # constant wherever c has a value
    rows = [tuple(None if pd.isna(v) else int(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in pdf.columns)).repartition(5)
    expected = pdf.astype("float64").corr().round(4)
    got = {r["column"]: r for r in association.correlation_matrix(df, list(pdf.columns)).collect()}
    for a in pdf.columns:
        for b in pdf.columns:
            want = expected.loc[a, b]
            assert (got[a][b] is None) if math.isnan(want) else got[a][b] == pytest.approx(want, abs=1e-4), (a, b)
    top = association.top_correlations(df, list(pdf.columns)).collect()
    assert {(r.col_a, r.col_b) for r in top[:2]} <= {("a", "big"), ("a", "b"), ("b", "big")}
    assert all(r.col_a != r.col_b for r in top)


def test_correlation_of_no_rows(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert [r["corr"] for r in association.pairwise_correlation(empty, ["a", "b"]).collect()] == [None] * 3


def test_duplicates_beyond_the_first(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert profiling.exact_duplicate_rows(df).first()[0] == 2
    assert profiling.exact_duplicate_rows(df.distinct()).first()[0] == 0
    assert profiling.exact_duplicate_rows(df.limit(0)).first()[0] == 0


def test_equal_numbers_of_different_rows_are_no_duplicates(spark, monkeypatch):
    """Numbers that tell nothing: every row is compared in full."""
    df = spark.createDataFrame([(1, None), (None, "1"), (2, "x"), (2, "x"), (3, "x")], "a int, b string")
    monkeypatch.setattr(profiling, "row_numbers", lambda columns: [F.lit(1).alias("_number"), F.lit(2).alias("_check")])
    assert profiling.exact_duplicate_rows(df).first()[0] == 1
    monkeypatch.undo()
    monkeypatch.setattr(profiling, "BROADCAST_NUMBERS", 0)
    assert profiling.exact_duplicate_rows(df).first()[0] == 1


def test_row_numbers_see_nulls_and_order(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a"), (None, None), ("", None)], "a string, b string")
    assert df.select(*profiling.row_numbers(["a", "b"])).distinct().count() == 5


def test_only_two_numbers_of_a_row_are_shuffled(spark, tmp_path):
    df = spark.range(1000).select(*[F.concat_ws("-", F.lit("x" * 200), "id").alias(f"c{i}") for i in range(30)])
    df.write.parquet(str(tmp_path / "wide"))
    plan = profiling.exact_duplicate_rows(spark.read.parquet(str(tmp_path / "wide")))._jdf.queryExecution().executedPlan().toString()
    # Whole rows are met with the numbers where they are read; what is exchanged after that are repeated rows.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def frequent(df, most):
    return sorted(tuple(r) for r in profiling.most_frequent_values(df, most).select("column", "place", "value", "n_rows").collect())


def test_frequent_values_are_proved_or_counted(spark, monkeypatch):
    """A column with a few hot values among very many, and one whose values are all alike."""
    hot = spark.range(60_000).select(F.lit("hot").alias("column"), F.when(F.col("id") % 10 < 6, F.concat(F.lit("h"), (F.col("id") % 10 % 3).cast("string")))
                                     .otherwise(F.col("id").cast("string")).alias("value"))
    flat = spark.range(300).select(F.lit("flat").alias("column"), (F.col("id") % 150).cast("string").alias("value"))
    both = hot.unionAll(flat)
    full = sorted(tuple(r) for r in profiling._counted_in_full(both, 3).select("column", "place", "value", "n_rows").collect())
    counted = []
    real = profiling._counted_in_full
    monkeypatch.setattr(profiling, "_counted_in_full", lambda long, most: counted.extend(r[0] for r in long.select("column").distinct().collect()) or real(long, most))
    assert frequent(both, 3) == full
    # The hot column was proved without counting its values; of the flat one nothing can be proved.
    assert counted == ["flat"]
    counted.clear()
    assert frequent(hot, 3) == full[-3:] and counted == []


def test_distinct_numbers_are_bits(spark):
    values = [0.0, -0.0, 1.0, 1.0, -1.0, 32768.0, 32769.0, 0.5, 1e300, float("nan"), float("nan"), float("inf"), None, 1048575.0, 1048576.0, -1048575.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None)], "column string, value double")
    found = {r["column"]: r.n_unique for r in profiling.distinct_numbers(df).collect()}
    assert found == {"a": df.where("value is not null").distinct().count()}
    many = spark.range(200_000).select(F.lit("a").alias("column"), (F.col("id") % 3000).cast("double").alias("value"))
    assert profiling.distinct_numbers(many).first().n_unique == 3000


def test_malformed_examples_keep_the_most_frequent(spark):
    texts = ["1", "_"] + [f"v{i}" for i in range(9) for _ in range(i)]
    df = spark.createDataFrame([(t, "2") for t in texts], "a string, b string")
    got = profiling.malformed_number_examples(df, ["a", "b"]).orderBy("column", "place").collect()
    assert [r.value for r in got[:5]] == ["v8", "v7", "v6", "v5", "v4"]
    assert got[0].non_numeric_rows == 37
    assert (got[5]["column"], got[5].non_numeric_rows, got[5].value) == ("b", 0, None)


def test_rank_limit_is_applied_before_the_exchange(spark):
    df = spark.createDataFrame([("x",)], "a string")
    plan = profiling._counted_in_full(ordered.unpivot(df, ["a"]), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_parse_verification(spark):
    df = spark.createDataFrame([("1_",), ("_",), ("__9__",), ("abc",), (None,)], "v string")
    both = apply_rules(df, [Rule("v", "v", parse_number)], with_raw=True)
    row = profiling.parse_verification(both, ["v"]).first()
    assert (row.sentinel_rows, row.null_after_parsing, row.present_but_unparsed, row.unexpected_nulls) == (2, 4, 3, 2)


def test_profiles_scan_once(spark, small):
    """Counts over many columns are one aggregate over one scan."""
    from vintagemart.sources import standins

    plan = profiling.missing_tokens(standins.financials(spark, small))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange SinglePartition") == 1


def test_partition_profile_counts_null_keys(spark):
    df = spark.createDataFrame([("a", "m"), (None, "m"), ("a", "n"), ("a", "n")], "k string, snapshot_date string")
    got = {r.snapshot_date: (r.n_rows, r.distinct_keys, r.key_is_unique) for r in profiling.profile_partitions(df, "k").collect()}
    assert got == {"m": (2, 2, 1), "n": (2, 1, 0)}


def test_text_profile(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None)], "x string, y string")
    got = {r["column"]: (r.null_rows, r.distinct_values) for r in profiling.string_profile(df, ["x", "y"]).collect()}
    assert got == {"x": (1, 1), "y": (3, 0)}


def test_a_lost_month_shows(spark):
    from datetime import date

    raw = {date(2024, 1, 1): 1, date(2024, 2, 1): 1}
    clean = spark.createDataFrame([(date(2024, 1, 1),), (None,)], "snapshot_date date")
    got = {r.snapshot_date: (r.raw_rows, r.clean_rows, r.preserved) for r in profiling.row_preservation(raw, clean, "t").collect()}
    assert got == {date(2024, 1, 1): (1, 1, 1), date(2024, 2, 1): (1, 0, 0), None: (0, 1, 0)}


def spread_of(df, columns):
    found = profiling.per_column_with_quantiles(
        df,
        columns,
        {
            "n": profiling.rows_with(lambda c: F.col(c).isNotNull()),
            "mean": profiling.moments(lambda m: F.when(m["n"] > 0, m["mean"])),
            "stddev": profiling.moments(lambda m: F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))),
        },
        {"p01": 0.01, "p50": 0.5, "p99": 0.99},
    )
    return {r["column"]: r for r in found.collect()}


def test_quantiles_and_moments_do_not_depend_on_the_tasks(spark):
    """Far more tasks than a step merges at once, some of them without rows."""
    df = spark.range(4000).select((1e6 + F.col("id") * 7 % 4001).alias("a"), F.when(F.col("id") % 3 == 0, -F.col("id")).alias("b"))
    want = df.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in "ab" for f in (F.avg, F.stddev_samp)]).first()
    exact = {c: df.agg(F.percentile_approx(F.col(c).cast("double"), [0.01, 0.5, 0.99], 1_000_000)).first()[0] for c in "ab"}
    for tasks in (1, 150):
        found = spread_of(df.repartition(tasks).unionAll(df.limit(0)), ["a", "b"])
        for c in "ab":
            assert [found[c][p] for p in ("p01", "p50", "p99")] == exact[c]
            assert found[c].mean == pytest.approx(want[f"{c}_avg"], rel=1e-12)
            assert found[c].stddev == pytest.approx(want[f"{c}_stddev_samp"], rel=1e-9)
        assert (found["a"].n, found["b"].n) == (4000, 1334)


def test_quantiles_beyond_the_exact_size_are_within_the_accuracy(spark):
    found = spread_of(spark.range(0, 400_000, 1, 16).select(F.col("id").cast("double").alias("a")), ["a"])["a"]
    for p, share in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)):
        assert abs(found[p] / 400_000 - share) < 5 / profiling.ACCURACY


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([(None,)], "a double")
    for empty in (df, df.limit(0)):
        found = spread_of(empty, ["a"])["a"]
        assert (found.n, found.mean, found.stddev, found.p01, found.p50, found.p99) == (0, None, None, None, None, None)
