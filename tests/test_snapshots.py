"""Sources, snapshot tables, calendar and backfills."""

from datetime import date

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from vintagemart.operators import checks, trailing
from vintagemart.plans import backfill
from vintagemart.plans.backfill import (
    Mart, backfill_features, backfill_labels, build_feature_store, clean, land, land_snapshot,
)
from vintagemart.schemas import ATTRIBUTES, FEEDS, LEDGER
from vintagemart.sources import snapshots as S, standins
from vintagemart.sources.calendar import months_between, parse_day, slice_months, trailing_months
from vintagemart.sources.scratch import discard, scratch_path, written


@pytest.fixture(scope="module")
def feeds(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("feeds")
    paths = {}
    for name, feed in standins.FEEDS.items():
        paths[name] = str(root / name)
        S.write_feed(feed(spark, small), paths[name])
    return paths


def feature_feeds(feeds):
    return {name: path for name, path in feeds.items() if name != "loan_daily"}


def rows(df):
    return sorted(map(repr, df.collect()))


def test_calendar():
    assert months_between("2023-11-15", "2024-02-01") == [
        date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert months_between("2024-02-10", "2024-02-01") == [date(2024, 2, 1)]
    assert months_between("2024-03-01", "2024-02-01") == []
    assert trailing_months("2024-01-01") == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1)]
    with pytest.raises(ValueError):
        parse_day("01/02/2024")


def test_feed_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text('snapshot_date,Extra,Age,Name,SSN,Occupation,Customer_ID\n'
                    '2024-01-01,x, 41_ ,"A ""B"", C",1,_______,CUS_1\n2024-01-01,x,,,,,CUS_2\n')
    got = S.read_feed(spark, str(path), ATTRIBUTES).orderBy("Customer_ID").collect()
    assert tuple(got[0]) == ("CUS_1", 'A "B", C', " 41_ ", "1", "_______", "2024-01-01")
    assert tuple(got[1]) == ("CUS_2", None, None, None, None, "2024-01-01")


def test_unreadable_ledger_values_become_null(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text(",".join(f.name for f in LEDGER) + "\nL1,C1,2023-01-01,ten,6,1000,100.5,x,0,,2023-07-01\n")
    row = S.read_feed(spark, str(path), LEDGER).first()
    assert (row.tenure, row.installment_num, row.due_amt, row.paid_amt, row.balance) == (None, 6, 100.5, None, None)


def test_text_and_date_slices(spark):
    df = spark.createDataFrame([(" 2024-01-01", date(2024, 1, 1)), ("2024-01-01", date(2024, 1, 1))], "t string, d date")
    assert slice_months(df, ["2024-01-01"], "t").count() == 2
    assert slice_months(df, ["2024-01-01"], "d").count() == 2


def test_writing_a_month_twice_changes_nothing_else(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2024, 1 + i % 3, 1)) for i in range(30)], "v int, snapshot_date date")
    assert S.write_snapshots(df, path, gather=True) == S.Written(30, [date(2024, m, 1) for m in (1, 2, 3)])
    february = df.filter("month(snapshot_date) = 2")
    for _ in range(2):
        S.write_snapshots(february, path, ["2024-02-01"])
        assert rows(S.read_snapshots(spark, path, df.schema)) == rows(df)


def test_rows_are_written_by_month_without_a_sort(spark, tmp_path, monkeypatch):
    conf, seen, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save
    before = spark.conf.get(conf)

    def watched(self, *args, **kwargs):
        seen.append(int(spark.conf.get(conf)))
        return save(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", watched)
    df = spark.range(60).selectExpr("cast(id as int) as v", "add_months(date'2024-01-01', cast(id % 6 as int)) as snapshot_date").coalesce(1)
    # Fewer open files than months: the rest is sorted, and nothing is lost.
    for i, most in enumerate((S.OPEN_MONTHS, 2)):
        monkeypatch.setattr(S, "OPEN_MONTHS", most)
        assert S.write_snapshots(df, str(tmp_path / f"t{i}")).rows == 60
        assert rows(S.read_snapshots(spark, str(tmp_path / f"t{i}"), df.schema)) == rows(df)
        assert S.rows_by_month(spark, str(tmp_path / f"t{i}")) == {date(2024, m, 1): 10 for m in range(1, 7)}
    with pytest.raises(Exception, match="not a date"):
        S.write_snapshots(df.withColumn("snapshot_date", F.lit("soon")), str(tmp_path / "bad"))
    assert seen == [64, 2, 2] and spark.conf.get(conf) == before


def test_feed_is_written_in_compressed_files_of_bounded_rows(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "FEED_FILE_ROWS", 1000)
    feed = standins.loan_daily(spark, small).limit(2500).coalesce(1)
    S.write_feed(feed, str(tmp_path / "f"))
    assert sorted(p.suffixes[-2:] for p in (tmp_path / "f").glob("part-*")) == [[".csv", ".gz"]] * 3
    assert rows(S.read_feed(spark, str(tmp_path / "f"), LEDGER)) == rows(feed)


def test_many_months_land_without_a_shuffle(spark, feeds, tmp_path):
    seen = []

    class Watched(Mart):
        def write(self, layer, table, df, months, **options):
            seen.append((layer, options["gather"], "Exchange" in df._jdf.queryExecution().executedPlan().toString()))
            return super().write(layer, table, df, months, **options)

    mart = Watched(spark, str(tmp_path / "m"))
    assert land(mart, "loan_daily", feeds["loan_daily"], months_between("2023-01-01", "2024-12-01")).rows == 16500
    land(mart, "loan_daily", feeds["loan_daily"], months_between("2023-01-01", "2023-01-01"))
    assert seen == [("bronze", False, False), ("bronze", True, False)]


def test_month_that_lost_its_rows_keeps_its_snapshot_unless_told(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2024, 1 + i % 2, 1)) for i in range(4)], "v int, snapshot_date date")
    S.write_snapshots(df, path)
    assert S.write_snapshots(df.limit(0), path, ["2024-02-01"]) == S.Written(0, [], [date(2024, 2, 1)])
    assert S.snapshots_present(spark, path) == [date(2024, 1, 1), date(2024, 2, 1)]
    S.write_snapshots(df.limit(0), path, ["2024-02-01"], drop_emptied=True)
    assert S.snapshots_present(spark, path) == [date(2024, 1, 1)]


def test_month_that_is_no_date_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, "2024-01-01")], "v int, snapshot_date string")
    S.write_snapshots(good, path)
    bad = spark.createDataFrame([(2, "2024-01-01"), (3, "soon")], "v int, snapshot_date string")
    with pytest.raises(Exception, match="not a date"):
        S.write_snapshots(bad, path)
    assert [r.v for r in S.read_snapshots(spark, path, good.schema).collect()] == [1]


def write_attributes(path, days):
    path.write_text("Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n" + "".join(f"C{i},n,30,1,x,{d}\n" for i, d in enumerate(days)))
    return str(path)


def test_padded_dates_are_landed_and_odd_ones_counted(spark, tmp_path):
    source = write_attributes(tmp_path / "a.csv", ["2023-01-01", " 2023-01-01", "2023-01-15", "never"])
    mart = Mart(spark, str(tmp_path / "m"))
    assert land_snapshot(mart, "attributes", source, "2023-01-01").rows == 2
    assert mart.unplaced["attributes"] == {"unreadable": 1, "off_month": 1}
    assert S.snapshots_present(spark, mart.path("bronze", "attributes")) == [date(2023, 1, 1)]


def test_a_source_without_an_older_month_deletes_nothing(spark, tmp_path):
    months = months_between("2023-01-01", "2023-02-01")
    mart = Mart(spark, str(tmp_path / "m"))
    land(mart, "attributes", write_attributes(tmp_path / "a.csv", ["2023-01-01", "2023-02-01"]), months)
    done = land(mart, "attributes", write_attributes(tmp_path / "b.csv", ["2023-02-01"]), months)
    assert done.emptied == [date(2023, 1, 1)]
    assert S.snapshots_present(spark, mart.path("bronze", "attributes")) == months


@pytest.mark.parametrize("lose", [
    lambda df: df.filter("snapshot_date <> date'2023-02-01'"),
    lambda df: df.withColumn("snapshot_date", F.when(F.month("snapshot_date") == 1, F.col("snapshot_date"))),
])
def test_a_month_lost_in_silver_stops_the_run(spark, tmp_path, monkeypatch, lose):
    months = months_between("2023-01-01", "2023-02-01")
    root = str(tmp_path / "m")
    land(Mart(spark, root), "attributes", write_attributes(tmp_path / "a.csv", ["2023-01-01", "2023-02-01"]), months)
    right = backfill.SILVER["attributes"]
    monkeypatch.setitem(backfill.SILVER, "attributes", lambda raw: lose(right(raw)))
    # Another object than the one that landed the months.
    with pytest.raises(checks.CheckFailed, match="2023-02-01: anchor 1, joined 0"):
        clean(Mart(spark, root), "attributes", months)


def test_repeated_key_is_found_where_silver_is_written(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"))
    source = tmp_path / "a.csv"
    write_attributes(source, ["2023-01-01"])
    source.write_text(source.read_text() + "C0,n,31,1,y,2023-01-01\n")
    months = months_between("2023-01-01", "2023-01-01")
    land(mart, "attributes", str(source), months)
    with pytest.raises(checks.CheckFailed, match="silver attributes: 1 repeated"):
        clean(mart, "attributes", months)


def table_files(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def mart_of_two_months(spark, tmp_path):
    """A good mart of two months, and sources in which February has a repeated key."""
    months = months_between("2023-01-01", "2023-02-01")
    mart = Mart(spark, str(tmp_path / "m"))
    land(mart, "attributes", write_attributes(tmp_path / "a.csv", ["2023-01-01", "2023-02-01"]), months)
    clean(mart, "attributes", months)
    bad = tmp_path / "b.csv"
    write_attributes(bad, ["2023-01-01", "2023-02-01"])
    bad.write_text(bad.read_text() + "C1,n,31,1,y,2023-02-01\n")
    return mart, months, str(bad)


def test_failed_audit_of_silver_leaves_every_file_as_it_was(spark, tmp_path):
    mart, months, bad = mart_of_two_months(spark, tmp_path)
    land(mart, "attributes", bad, months)
    before, shown = table_files(tmp_path / "m" / "silver"), rows(mart.silver("attributes"))
    with pytest.raises(checks.CheckFailed, match="1 repeated"):
        clean(mart, "attributes", months)
    # January would have been right, but a run is shown whole or not at all.
    assert table_files(tmp_path / "m" / "silver") == before
    assert rows(Mart(spark, mart.root).silver("attributes")) == shown


def test_failed_audit_of_the_store_leaves_every_file_as_it_was(spark, feeds, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"))
    backfill_features(mart, feature_feeds(feeds), "2023-01-01", "2023-02-01")
    before, shown, coverage = table_files(tmp_path / "m" / "gold"), rows(mart.feature_store()), mart.coverage
    silver = mart.silver("financials", ["2023-02-01"])
    mart.write("silver", "financials", written(silver.unionAll(silver.limit(1)), "doubled"), [])
    with pytest.raises(checks.CheckFailed, match="2023-02-01"):
        build_feature_store(mart, months_between("2023-01-01", "2023-02-01"))
    assert table_files(tmp_path / "m" / "gold") == before
    assert rows(mart.feature_store()) == shown and mart.coverage == coverage


def test_run_killed_between_staging_and_publishing(spark, tmp_path, monkeypatch):
    mart, months, _ = mart_of_two_months(spark, tmp_path)
    shown = rows(mart.silver("attributes"))
    better = write_attributes(tmp_path / "c.csv", ["2023-01-01", "2023-02-01", "2023-02-01"])
    land(mart, "attributes", better, months)

    def killed(*_, **__):
        raise SystemExit

    monkeypatch.setattr(backfill, "publish", killed)
    with pytest.raises(SystemExit):
        clean(mart, "attributes", months)
    monkeypatch.undo()
    path = mart.path("silver", "attributes")
    # What was staged is there, nobody sees it, and it can be taken away or done again.
    assert rows(mart.silver("attributes")) == shown
    assert S.remove_unshown(spark, path) == []
    assert len(S.remove_unshown(spark, path, older_than_hours=-1)) == 2
    assert rows(mart.silver("attributes")) == shown
    clean(mart, "attributes", months)
    assert mart.silver("attributes").count() == 3


def test_months_of_a_run_become_visible_together(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2024, 1 + i % 3, 1)) for i in range(30)], "v int, snapshot_date date")
    S.write_snapshots(df, path)
    staged = S.stage_snapshots(df.filter("v < 15"), path, ["2024-01-01", "2024-02-01", "2024-03-01"])
    assert staged.rows_by_month == {date(2024, m, 1): 5 for m in (1, 2, 3)}
    assert rows(staged.rows(spark)) == rows(df.filter("v < 15"))
    assert rows(S.read_snapshots(spark, path, df.schema)) == rows(df)
    S.publish(spark, staged)
    assert rows(S.read_snapshots(spark, path, df.schema)) == rows(df.filter("v < 15"))
    assert S.rows_by_month(spark, path) == staged.rows_by_month


def test_two_runs_publishing_at_once_both_count(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2024, 1 + i % 2, 1)) for i in range(4)], "v int, snapshot_date date")
    one, two = (S.stage_snapshots(df.filter(f"month(snapshot_date) = {m}"), path) for m in (1, 2))
    seen = []

    def late(shown):
        # While this run decides, another one publishes.
        if not seen:
            seen.append(S.publish(spark, two))
        return shown | one.shown

    S.pointer.change(spark, path, late)
    assert rows(S.read_snapshots(spark, path, df.schema)) == rows(df)


@pytest.mark.parametrize("fmt", S.FORMATS)
def test_rows_of_months_nobody_named_are_counted(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01"), (3, None), (4, None)], "v int, snapshot_date string")
    assert S.write_snapshots(df, path, ["2024-01-01"], fmt=fmt) == S.Written(4, months_between("2024-01-01", "2024-02-01"))
    assert S.rows_by_month(spark, path) == {date(2024, 1, 1): 1, date(2024, 2, 1): 1, None: 2}
    assert sorted(r.v for r in S.read_snapshots(spark, path, df.schema, fmt=fmt).collect()) == [1, 2, 3, 4]


def test_audit_reads_neither_bronze_nor_the_values_of_silver(spark, tmp_path, monkeypatch):
    """Parity goes by the counts of the writes: bronze is gone when silver is audited."""
    mart, months, _ = mart_of_two_months(spark, tmp_path)
    land(mart, "attributes", write_attributes(tmp_path / "c.csv", ["2023-01-01", "2023-02-01"]), months)
    real = backfill.checks.require_row_parity

    def without_bronze(*args):
        discard(spark, mart.path("bronze", "attributes"))
        real(*args)

    monkeypatch.setattr(backfill.checks, "require_row_parity", without_bronze)
    assert clean(mart, "attributes", months).rows == 2


def test_decimal_points_in_whole_ledger_columns(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text(",".join(f.name for f in LEDGER) + "\nL1,C1,2023-01-01,10.0,6.0,1000,100,0,150,0,2023-07-01\n")
    store = backfill_labels(Mart(spark, str(tmp_path / "m")), str(path), "2023-07-01", "2023-07-01")
    assert [(r.loan_id, r.label) for r in store.collect()] == [("L1", 1)]


def test_table_without_snapshots(spark, tmp_path):
    with pytest.raises(S.NoSnapshots):
        S.read_snapshots(spark, str(tmp_path / "none"), ATTRIBUTES)


def test_one_month_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, date(2024, 1 + i % 3, 1)) for i in range(30)], "v int, snapshot_date date")
    S.write_snapshots(df, path)
    read = S.read_snapshot(spark, path, df.schema, "2024-02-01")
    assert len(read.inputFiles()) >= 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "DataFilters: []" in plan


def test_scratch_is_in_the_shared_folder(spark, tmp_path):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    path = str(tmp_path / "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    assert not (tmp_path / "gone").exists()
    discard(spark, path)
    assert rows(written(spark.range(3).toDF("id"), "x")) == rows(spark.range(3))


@pytest.mark.parametrize("fmt", S.FORMATS)
def test_label_backfill(spark, feeds, tmp_path, fmt):
    mart = Mart(spark, str(tmp_path / fmt), bronze_format=fmt)
    store = backfill_labels(mart, feeds["loan_daily"], "2023-01-01", "2024-12-01")
    assert mart.written["bronze/loan_daily"].rows == mart.written["silver/loan_daily"].rows > 0
    assert store.count() == mart.written["gold/label_store"].rows
    before = rows(mart.label_store())
    backfill_labels(mart, feeds["loan_daily"], "2023-09-01", "2023-09-01")
    assert rows(mart.label_store()) == before


def test_feature_backfill_month_by_month_equals_all_at_once(spark, feeds, tmp_path):
    whole = Mart(spark, str(tmp_path / "whole"))
    backfill_features(whole, feature_feeds(feeds), "2023-01-01", "2023-04-01")
    parts = Mart(spark, str(tmp_path / "parts"))
    for month in months_between("2023-01-01", "2023-04-01"):
        backfill_features(parts, feature_feeds(feeds), month, month)
    # A fresh object reads what the other one wrote.
    assert rows(Mart(spark, parts.root).feature_store()) == rows(whole.feature_store())


def test_clickstream_may_be_absent_but_the_cohort_may_not(spark, feeds, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"))
    needed = {name: feeds[name] for name in ("attributes", "financials")}
    store = backfill_features(mart, needed, "2023-01-01", "2023-02-01")
    assert store.agg(F.sum("has_clickstream"), F.count("fe_1"), F.count("fe_1_mean_3m")).first() == (0, 0, 0)
    with pytest.raises(checks.CheckFailed, match="silver attributes: no snapshot for 2023-03-01"):
        build_feature_store(mart, months_between("2023-01-01", "2023-03-01"))


def test_repeated_side_key_stops_the_store(spark, feeds, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"))
    backfill_features(mart, feature_feeds(feeds), "2023-01-01", "2023-01-01")
    assert mart.coverage == mart.feature_store().agg(
        F.sum("has_clickstream").alias("rows_with_clickstream"),
        F.sum("has_full_clickstream_3m_history").alias("rows_with_full_3m_history"),
    ).first().asDict()
    silver = mart.silver("financials")
    mart.write("silver", "financials", written(silver.unionAll(silver.limit(1)), "doubled"), [])
    with pytest.raises(checks.CheckFailed, match="row counts differ"):
        build_feature_store(mart, months_between("2023-01-01", "2023-01-01"))


def test_store_of_bucketed_tables_needs_no_exchange(spark, feeds, tmp_path):
    """Window and three-way join by customer, over months of several runs."""
    plain = Mart(spark, str(tmp_path / "plain"))
    backfill_features(plain, feature_feeds(feeds), "2023-01-01", "2023-03-01")
    mart = Mart(spark, str(tmp_path / "m"), buckets=4)
    backfill_features(mart, feature_feeds(feeds), "2023-01-01", "2023-02-01")
    backfill_features(mart, feature_feeds(feeds), "2023-03-01", "2023-03-01")
    months = months_between("2023-01-01", "2023-03-01")
    assert rows(mart.feature_store()) == rows(plain.feature_store())
    assert mart.rows("silver", "clickstream", months) == plain.rows("silver", "clickstream", months)

    # The session's owner says that tables dealt by a part of a join's key may be joined as they are.
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}

    def exchanges(df):
        for name, value in settings.items():
            spark.conf.set(name, value)
        try:
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange")
        finally:
            for name in settings:
                spark.conf.unset(name)

    assert exchanges(backfill.assembled(mart, months)) == 0
    assert exchanges(backfill.assembled(plain, months)) > 0
    assert exchanges(trailing.gold_clickstream(mart.silver("clickstream"))) == 0
    one = mart.silver("attributes", ["2023-02-01"])
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()
    S.forget_tables(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("vintagemart")]
    assert rows(Mart(spark, mart.root).feature_store()) == rows(plain.feature_store())


def test_single_month_bronze(spark, feeds, tmp_path):
    mart = Mart(spark, str(tmp_path / "m"))
    land_snapshot(mart, "loan_daily", feeds["loan_daily"], "2023-04-01")
    assert S.snapshots_present(spark, mart.path("bronze", "loan_daily")) == [date(2023, 4, 1)]
    source = S.read_feed(spark, feeds["loan_daily"], FEEDS["loan_daily"])
    assert rows(mart.bronze("loan_daily")) == rows(slice_months(source, ["2023-04-01"]))
