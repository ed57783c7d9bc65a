"""Distances between neighbouring values, without a global window.

Values are first counted per group, which combines on the map side and turns any
hot value into one row.  The distinct values are then laid out in order, by group and
value, in as many ranges as their number asks for, so even a single group
with very many values is spread over tasks.  A task sets each value beside the one before it;
what crosses the start of a range (the last value before it) is one row per range and group,
joined back by broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import written

GROUP = "column"
VALUE = "value"

# Distinct values of a range; results do not depend on it.
RANGE_VALUES = 500_000


def unpivot(df: DataFrame, columns: Sequence[str], cast: str | None = None) -> DataFrame:
    """(column, value) rows of several columns, cast to a common type if one is given."""
    if cast:
        df = df.select(*[F.col(c).cast(cast).alias(c) for c in columns])
    else:
        df = df.select(*columns)
    return df.unpivot([], list(columns), GROUP, VALUE)


def count_values(long: DataFrame) -> DataFrame:
    """Distinct non-NULL values per group with their number of rows."""
    return long.filter(F.col(VALUE).isNotNull()).groupBy(GROUP, VALUE).agg(F.count(F.lit(1)).alias("n"))


def _beside_the_one_before(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """From rows in order, each with the value before it in its group; none for the first of a range."""
    group = value = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, values, counts, ranges = (batch.column(i) for i in range(4))
        before = pa.concat_arrays([pa.array([value], values.type), values.slice(0, len(values) - 1)])
        others = pa.concat_arrays([pa.array([group], groups.type), groups.slice(0, len(groups) - 1)])
        same = pc.fill_null(pc.equal(groups, others), False)
        before = pc.if_else(same, before, pa.scalar(None, values.type))
        group, value = groups[-1].as_py(), values[-1].as_py()
        yield pa.RecordBatch.from_arrays([groups, values, counts, ranges, before], schema=schema)


def value_gaps(counted: DataFrame, range_values: int = RANGE_VALUES) -> DataFrame:
    """Each distinct value with its count, the next smaller value, and the distance to it."""
    # Written, so that values are counted once and the bounds of ranges are the same for all that follows.
    counted = written(counted.select(GROUP, VALUE, "n"), "values")
    ranges = max(1, math.ceil(counted.count() / range_values))
    laid_out = counted.repartitionByRange(ranges, GROUP, VALUE).sortWithinPartitions(GROUP, VALUE)
    numbered = laid_out.withColumn("range_no", F.spark_partition_id())
    schema = numbered.withColumn("previous", F.col(VALUE)).schema
    arrow = pa.schema([f.with_nullable(True) for f in to_arrow_schema(schema)])
    beside = written(numbered.mapInArrow(lambda batches: _beside_the_one_before(batches, arrow), schema), "neighbours")
    last = beside.groupBy(GROUP, "range_no").agg(F.max(VALUE).alias("last"))
    before = F.lag("last").over(Window.partitionBy(GROUP).orderBy("range_no"))
    # One row per group and range.
    stitches = F.broadcast(last.select(GROUP, "range_no", before.alias("last_before")))
    previous = F.coalesce("previous", "last_before")
    return beside.join(stitches, [GROUP, "range_no"]).select(
        GROUP, VALUE, "n", previous.alias("previous_value")
    ).withColumn("gap", F.col(VALUE) - F.col("previous_value"))
