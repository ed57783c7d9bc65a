"""Feed sources, and snapshot tables partitioned by month.

A run writes its months beside what is there, ``<path>/data/run=<name>/snapshot_date=2023-01-01/``,
where nobody reads them.  What was staged can be checked and then either be published or be thrown
away.  Publishing is one small file that names the run of every month (see ``pointer``): the
months of a run become visible together, other months stay as they are, and a run that
fails or dies before that has changed nothing.  The file also holds the rows of every month,
counted by the job that wrote them.  Reading a few months touches only their partitions.

A table may lie in buckets of a key: then each run is dealt by that key when it is written, and months of
the same buckets are read as one bucketed table, so that joins, aggregates and windows by the key need no exchange.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import only_if, typed
from . import pointer
from .calendar import day_of, parse_day, slice_months
from .scratch import discard

PARTITION = "snapshot_date"
FORMATS = ("parquet", "csv")

# Fixed value: the folder Spark gives to rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Quotes inside a value are doubled; blanks around a value are part of it.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# Rows of one compressed file of a feed: such a file is read by one task.
FEED_FILE_ROWS = 1_000_000

# Months whose files a task of a write holds open at once; only rows of further months are sorted before
# they are written.
OPEN_MONTHS = 64
_OPEN_CONF = "spark.sql.maxConcurrentOutputFileWriters"


class NoSnapshots(FileNotFoundError):
    """A table has no snapshot at all."""


def read_feed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A feed's CSV with a header, columns taken by name and given the declared types.

    Only the header line is read beforehand; the file is scanned once, by the
    query itself.  Values that do not fit their type become NULL; whole numbers
    may be written with a decimal point.
    """
    text = spark.read.options(**CSV_OPTIONS, inferSchema=False).csv(path)
    return text.select(*[typed(F.col(f.name), f.dataType).alias(f.name) for f in schema])


def write_feed(df: DataFrame, path: str) -> None:
    """The rows as compressed CSV in the form ``read_feed`` expects."""
    df.write.options(**CSV_OPTIONS, compression="gzip", maxRecordsPerFile=FEED_FILE_ROWS).csv(path)


def _options(fmt: str) -> dict:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {FORMATS}")
    return CSV_OPTIONS if fmt == "csv" else {}


@contextmanager
def _months_open(spark: SparkSession) -> Iterator[None]:
    """Writes by month put every row into its month's open file, instead of sorting what a task has by month."""
    before = spark.conf.get(_OPEN_CONF, None)
    spark.conf.set(_OPEN_CONF, OPEN_MONTHS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_CONF)
        else:
            spark.conf.set(_OPEN_CONF, before)


@dataclass(frozen=True)
class Buckets:
    """Rows are dealt into so many buckets by a hash of the column.

    As many as tasks the largest table asks for; every month has a file in each.
    """

    column: str
    number: int


@dataclass(frozen=True)
class Written:
    """What one write put into a table, counted by the write itself."""

    rows: int
    months: list[date]
    # Months asked for that had no rows; their older snapshots stay unless told otherwise.
    emptied: list[date] = field(default_factory=list)


@dataclass(frozen=True)
class Staged:
    """A run whose rows are written and not yet shown."""

    path: str
    run: str
    fmt: str
    schema: StructType
    shown: dict[str, pointer.Shown]
    asked: list[date]

    @property
    def rows_by_month(self) -> dict[date | None, int]:
        return _by_day(self.shown)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The staged rows, for checks before they are published."""
        return _read(spark, self.path, self.schema, self.shown.values(), self.fmt)


def stage_snapshots(
    df: DataFrame,
    path: str,
    months: Iterable[str | date] = (),
    *,
    fmt: str = "parquet",
    gather: bool = False,
    buckets: Buckets | None = None,
) -> Staged:
    """Write the rows by month to a run of their own; readers do not see it.

    ``gather`` first brings the rows of a month together.  It is a rebalance, not
    a plain repartition: a month with a large share of the rows is split over
    several tasks and small ones share one, so files have an even size.  Leave it
    off for rows that come from a table already laid out by month, and for many rows of many months, which then
    are written where they are, a file for each month a task has.  ``buckets`` (of a Parquet table) deals the
    rows by a key instead.

    ``months`` are the months this run is about; the rows of each are counted by the stage that
    writes.  A month that is not a date fails the write.
    """
    spark, schema = df.sparkSession, df.schema
    asked = sorted({parse_day(m) for m in months})
    day, month = day_of(df, PARTITION), F.col(PARTITION)
    df = df.withColumn(PARTITION, only_if(month.isNull() | day.isNotNull(), "a snapshot month is not a date", month))
    if buckets:
        df = df.repartition(buckets.number, buckets.column)
    elif gather:
        df = df.hint("rebalance", F.col(PARTITION))
    # Observed in the stage that writes, where a task that is run again counts once.
    seen = Observation()
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(day.isNull()).alias("no_month"),
        *[F.count_if(day == F.lit(m)).alias(m.isoformat()) for m in asked],
    )
    run = f"r{uuid.uuid4().hex}"
    folder = f"{path}/data/run={run}"
    writer = counted.write.partitionBy(PARTITION).format(fmt).options(**_options(fmt))
    if buckets:
        # Only tables of the catalog are written in buckets; the files stay when the table is forgotten.
        name = f"vintagemart_{run}"
        writer.bucketBy(buckets.number, buckets.column).sortBy(buckets.column).option("path", folder).saveAsTable(name)
        spark.sql(f"drop table {name}")
    else:
        with _months_open(spark):
            writer.save(folder)
    folders: dict[str, list[str]] = {}
    for name in pointer.names_below(spark, folder):
        if name.startswith(f"{PARTITION}="):
            folders.setdefault(_month_of(name), []).append(name)
    found = seen.get
    counts = {m.isoformat(): found[m.isoformat()] for m in asked} | {"": found["no_month"]}
    if sum(counts.values()) != found["rows"]:
        # Rows of months nobody named: counted in what was written, from the partitions alone.
        whole = _read(spark, path, schema, [pointer.Shown(run, sorted(sum(folders.values(), [])), 0)], fmt)
        days = whole.groupBy(day_of(whole, PARTITION).cast("string").alias("day")).count().collect()
        counts = {r.day or "": r["count"] for r in days}
    layout = [buckets.column, buckets.number] if buckets else None
    shown = {m: pointer.Shown(run, sorted(names), counts[m], layout) for m, names in folders.items()}
    return Staged(path, run, fmt, schema, shown, asked)


def publish(spark: SparkSession, staged: Staged, *, drop_emptied: bool = False) -> Written:
    """Show the staged months in place of older ones, all of them at once.

    Months the run was about that have no rows are reported; an older snapshot of
    theirs stays, unless ``drop_emptied`` asks for its removal.
    """
    found = {m for m in staged.rows_by_month if m is not None}
    emptied = sorted(set(staged.asked) - found)

    def new(shown: dict[str, pointer.Shown]) -> dict[str, pointer.Shown]:
        gone = {m.isoformat() for m in emptied} if drop_emptied else set()
        return {m: s for m, s in shown.items() if m not in gone} | staged.shown

    pointer.change(spark, staged.path, new)
    return Written(sum(s.rows for s in staged.shown.values()), sorted(found), emptied)


def discard_staged(spark: SparkSession, staged: Staged) -> None:
    """Throw a run away that will not be published."""
    discard(spark, f"{staged.path}/data/run={staged.run}")


def write_snapshots(
    df: DataFrame,
    path: str,
    months: Iterable[str | date] = (),
    *,
    fmt: str = "parquet",
    gather: bool = False,
    drop_emptied: bool = False,
) -> Written:
    """Replace the snapshots the rows belong to, unchecked; other months stay as they are."""
    return publish(df.sparkSession, stage_snapshots(df, path, months, fmt=fmt, gather=gather), drop_emptied=drop_emptied)


def remove_unshown(spark: SparkSession, path: str, *, older_than_hours: float = 24) -> list[str]:
    """Remove months of runs that were replaced, and runs that were never published.

    Folders younger than the given age stay, since a run may still be at work on them
    and a reader may have them open.  Returns what was removed, as ``run/month`` folders.
    """
    _, shown = pointer.current(spark, path)
    kept = {f"run={s.run}/{folder}" for s in shown.values() for folder in s.folders}
    before = (time.time() - older_than_hours * 3600) * 1000
    removed = []
    for run in pointer.names_below(spark, f"{path}/data"):
        folder, files = pointer.file_system(spark, f"{path}/data/{run}")
        for status in files.listStatus(folder):
            name = f"{run}/{status.getPath().getName()}"
            if status.isDirectory() and name not in kept and status.getModificationTime() <= before:
                discard(spark, f"{path}/data/{name}")
                removed.append(name)
    return sorted(removed)


def _month_of(folder: str) -> str:
    """The month a partition folder holds; nothing for rows without one."""
    name = unquote(folder.removeprefix(f"{PARTITION}="))
    return "" if name == NO_DATE else parse_day(name.strip()).isoformat()


def _by_day(shown: dict[str, pointer.Shown]) -> dict[date | None, int]:
    return {parse_day(m) if m else None: s.rows for m, s in shown.items()}


# Names of bucketed tables this process has made in the catalog, by application.
_TABLES: dict[str, list[str]] = {}


def forget_tables(spark: SparkSession) -> None:
    """Take the bucketed tables this application has read out of the catalog; their files stay.

    DataFrames made of them cannot be run any more.  A catalog in memory ends with its application anyway.
    """
    for name in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {name}")


def _bucketed(spark: SparkSession, path: str, schema: StructType, shown: list[pointer.Shown]) -> DataFrame:
    """Months of the same buckets as one table, whose partitions lie where their runs wrote them."""
    column, number = shown[0].buckets
    name = f"vintagemart_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"create table {name} ({columns}) using parquet partitioned by (`{PARTITION}`) "
        f"clustered by (`{column}`) sorted by (`{column}`) into {number} buckets location '{path}/data'"
    )
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    places = [(unquote(folder.removeprefix(f"{PARTITION}=")), f"{path}/data/run={s.run}/{folder}") for s in shown for folder in s.folders]
    spark.sql(f"alter table {name} add " + " ".join(f"partition (`{PARTITION}`='{value}') location '{at}'" for value, at in places))
    return spark.table(name).select(*schema.names)


def _read(spark: SparkSession, path: str, schema: StructType, shown: Iterable[pointer.Shown], fmt: str) -> DataFrame:
    shown = list(shown)
    dated = all(NO_DATE not in folder for s in shown for folder in s.folders)
    if shown and dated and shown[0].buckets and all(s.buckets == shown[0].buckets for s in shown):
        return _bucketed(spark, path, schema, shown)
    folders = [f"{path}/data/run={s.run}/{folder}" for s in shown for folder in s.folders]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(**_options(fmt)).option("basePath", f"{path}/data").format(fmt)
    return reader.load(folders).select(*schema.names)


def rows_by_month(spark: SparkSession, path: str) -> dict[date | None, int]:
    """Rows of every month a table shows, as its writes counted them; no data is read."""
    return _by_day(pointer.current(spark, path)[1])


def snapshots_present(spark: SparkSession, path: str) -> list[date]:
    """Months a table shows, in order; no data is read."""
    return sorted(m for m in rows_by_month(spark, path) if m is not None)


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: StructType,
    months: Sequence[str | date] | None = None,
    *,
    fmt: str = "parquet",
) -> DataFrame:
    """All snapshots of a table, or those of the given months that exist.

    Asking for everything in a table without a snapshot is an error; asking for
    months that do not exist gives no rows.
    """
    _, shown = pointer.current(spark, path)
    if months is None:
        if not shown:
            raise NoSnapshots(f"no snapshots in {path}")
        return _read(spark, path, schema, shown.values(), fmt)
    wanted = sorted({parse_day(m).isoformat() for m in months} & set(shown))
    return slice_months(_read(spark, path, schema, [shown[m] for m in wanted], fmt), months)


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType, month: str | date, *, fmt: str = "parquet"
) -> DataFrame:
    return read_snapshots(spark, path, schema, [month], fmt=fmt)


def union_snapshots(frames: Iterable[DataFrame]) -> DataFrame:
    """Snapshots as one table, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)
