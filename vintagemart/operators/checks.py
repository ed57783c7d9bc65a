"""Grain, completeness and row-count checks.

Each check is a DataFrame of violations (so it can be queried, joined or
stored) plus a function that raises when there are any.  Violations are found
by aggregates that combine on the map side, so a key that holds a large share
of the rows still reaches its reducer as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..schemas import FEATURE_KEY


class CheckFailed(ValueError):
    """A table breaks its grain, loses rows, or lacks a required snapshot."""


def duplicate_keys(df: DataFrame, keys: Sequence[str] = FEATURE_KEY) -> DataFrame:
    """Every key that occurs more than once, with its number of rows; NULL keys group together."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, name: str, keys: Sequence[str] = FEATURE_KEY) -> None:
    repeated = duplicate_keys(df, keys).count()
    if repeated:
        raise CheckFailed(f"{name}: {repeated} repeated ({', '.join(keys)}) keys")


def row_parity(anchor: DataFrame, joined: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows per snapshot of the anchor and of the table joined onto it, in one aggregate."""

    def tally(df: DataFrame, left: int) -> DataFrame:
        return df.select(by, F.lit(left).alias("a"), F.lit(1 - left).alias("j"))

    both = tally(anchor, 1).unionByName(tally(joined, 0))
    counts = both.groupBy(by).agg(F.sum("a").alias("anchor_rows"), F.sum("j").alias("joined_rows"))
    return counts.select("*", (F.col("anchor_rows") == F.col("joined_rows")).cast("int").alias("matches"))


def require_row_parity(anchor: Mapping[date | None, int], joined: Mapping[date | None, int], name: str) -> None:
    """Fail unless two tables have the same rows in every month, by the counts of those who wrote them."""
    months = sorted(set(anchor) | set(joined), key=lambda m: (m is not None, m))
    broken = [(m, anchor.get(m, 0), joined.get(m, 0)) for m in months if anchor.get(m, 0) != joined.get(m, 0)]
    if broken:
        detail = "; ".join(f"{m}: anchor {a}, joined {j}" for m, a, j in broken)
        raise CheckFailed(f"{name}: row counts differ from the anchor ({detail})")


def missing_snapshots(spine: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Months of the spine for which a table has no snapshot.

    Tables are reduced to their distinct months first, so the anti join is
    between two lists of months per table.
    """
    present = None
    for name, df in tables.items():
        months = df.select(F.lit(name).alias("table"), "snapshot_date").distinct()
        present = months if present is None else present.unionByName(months)
    names = F.array(*[F.lit(name) for name in tables])
    wanted = spine.select(F.explode(names).alias("table"), "snapshot_date")
    return wanted.join(present, ["table", "snapshot_date"], "left_anti")


def require_snapshots(present: Iterable[date], wanted: Iterable[date], name: str) -> None:
    absent = sorted(set(wanted) - set(present))
    if absent:
        raise CheckFailed(f"{name}: no snapshot for {', '.join(map(str, absent))}")


def key_sides(sides: Mapping[str, DataFrame], keys: Sequence[str] = FEATURE_KEY) -> DataFrame:
    """Every distinct key with one 0/1 column per table that holds it.

    One aggregate replaces distinct plus anti joins in each direction.  As in an
    equi-join, a key containing NULL matches nothing: each table keeps its own.
    """
    names = list(sides)
    tagged = None
    for name in names:
        tag = [F.lit(int(other == name)).alias(other) for other in names]
        part = sides[name].select(*keys, *tag)
        tagged = part if tagged is None else tagged.unionByName(part)
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    # The own tag keeps NULL-holding keys of different tables apart.
    apart = F.when(has_null, F.concat_ws("", *names)).otherwise("")
    return (
        tagged.groupBy(*keys, apart.alias("apart"))
        .agg(*[F.max(name).alias(name) for name in names])
        .drop("apart")
    )


# Bits of a membership filter: 8 MB, whatever it is made of.  With far more keys than bits any key may be one
# of them, and all are joined.
FILTER_BITS = 1 << 26

# Bits of a whole number, and numbers in one row of a filter.
_WORD, _ROW = 64, 1024


def membership(df: DataFrame, keys: Sequence[str] = FEATURE_KEY, bits: int = FILTER_BITS) -> DataFrame:
    """The keys of a table as a fixed number of bits, in rows of whole numbers: (row, words).

    Bits are put together in the tasks that read the keys; no key is shuffled.
    """
    slots = df.select(F.pmod(F.xxhash64(*keys), F.lit(bits)).alias("slot"))
    marks = slots.selectExpr(f"slot div {_WORD} as word", f"shiftleft(1L, cast(slot % {_WORD} as int)) as mark")
    # Every number is there, so that its place in its row is its index.
    none = df.sparkSession.range(bits // _WORD).selectExpr("id as word", "0L as mark")
    whole = marks.unionByName(none).groupBy("word").agg(F.bit_or("mark").alias("mark"))
    rows = whole.groupBy(F.expr(f"word div {_ROW}").alias("row")).agg(F.sort_array(F.collect_list(F.struct("word", "mark"))).alias("words"))
    return rows.select("row", F.col("words.mark").alias("words"))


def with_membership(df: DataFrame, filter_: DataFrame, keys: Sequence[str] = FEATURE_KEY, bits: int = FILTER_BITS, name: str = "may_match") -> DataFrame:
    """The rows, told apart by whether their key may be in the table the filter is made of.

    Of those that may not none is; a key with a NULL matches nothing.  Nothing is shuffled.
    """
    slot = f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {bits})"
    placed = df.withColumn("_slot", F.expr(slot)).withColumn("row", F.expr(f"_slot div {_WORD * _ROW}"))
    # FILTER_BITS bits.
    met = placed.join(F.broadcast(filter_), "row", "left")
    marked = F.expr(f"shiftright(get(words, cast(_slot div {_WORD} % {_ROW} as int)), cast(_slot % {_WORD} as int)) & 1L") == 1
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return met.withColumn(name, F.coalesce(marked & known, F.lit(False))).drop("_slot", "row", "words")


def unmatched_keys(left: DataFrame, right: DataFrame, left_name: str, right_name: str, *, unique: bool = False) -> DataFrame:
    """Distinct keys that only one of two tables holds, and which table that is.

    A key that misses the other table's membership filter is unmatched where it is read; only keys that may match
    are brought together.  ``unique`` says that both tables have their grain, so that keys need not be made
    distinct, which they otherwise are after their repetitions in a task are one.
    """
    sides = {left_name: left.select(*FEATURE_KEY), right_name: right.select(*FEATURE_KEY)}
    met = {
        name: with_membership(sides[name], membership(sides[other]))
        for name, other in ((left_name, right_name), (right_name, left_name))
    }
    maybe = key_sides({name: df.filter("may_match") for name, df in met.items()})
    lonely = maybe.filter(F.col(left_name) != F.col(right_name))
    only_in = F.when(F.col(left_name) == 1, left_name).otherwise(right_name)
    found = lonely.select(*FEATURE_KEY, only_in.alias("only_in"))
    for name, df in met.items():
        missed = df.filter("not may_match").select(*FEATURE_KEY, F.lit(name).alias("only_in"))
        found = found.unionByName(missed if unique else missed.distinct())
    return found
