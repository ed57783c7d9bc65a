"""Pairwise Pearson correlation without collecting rows.

Every task turns its rows into one matrix of moments per pair (a few hundred
numbers, however many rows it had), taken around the task's own means; the
moments of all tasks are then put together by an ordinary aggregate.  A
correlation over the rows that have both values needs six numbers for each of the
190 pairs of 20 columns: as SQL aggregates those are too many for generated code,
as matrix products they are four BLAS calls per Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# Digits kept, and length of the strongest-pairs list.
DIGITS = 4
TOP_PAIRS = 20

# A spread below this share of the sum of squares it was taken from is rounding noise of a
# constant, and so is one below the square of what a double can tell of the values themselves.
NOISE, GRAIN = 1e-12, 1e-28

MOMENTS = ("n", "mx", "my", "sxx", "syy", "sxy", "rxx", "ryy")


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per task and pair (i <= j): rows with both values, their means, and sums of products around the means."""
    width = len(columns)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, shift = np.zeros((6, width, width)), None
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            known = ~np.isnan(raw)
            if shift is None:
                # Near enough to the means to keep the sums of squares accurate.
                shift = np.where(known, raw, 0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
            present = known.astype("float64")
            x = np.where(known, raw - shift, 0.0)
            sum_x, sum_xx = x.T @ present, (x * x).T @ present
            total += [present.T @ present, sum_x, sum_x.T, sum_xx, sum_xx.T, x.T @ x]
        if shift is None:
            return
        n, sx, sy, sxx, syy, sxy = total
        rows = np.maximum(n, 1)
        out = [n, sx / rows + shift[:, None], sy / rows + shift[None, :], sxx - sx * sx / rows, syy - sy * sy / rows, sxy - sx * sy / rows, sxx, syy]
        i, j = np.triu_indices(width)
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in out]]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", *MOMENTS])

    schema = "i int, j int, " + ", ".join(f"{m} double" for m in MOMENTS)
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(moments, schema)


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per pair the moments of all rows: the tasks' own, and what the distances of their means add."""
    # One row per task in a pair's window.
    pair = Window.partitionBy("i", "j")
    known = pair_moments(df, columns).where("n > 0")
    centred = known.select(
        "*",
        *[(F.col(m) - F.sum(F.col("n") * F.col(m)).over(pair) / F.sum("n").over(pair)).alias(f"d{m}") for m in ("mx", "my")],
    )

    def whole(s: str, a: str, b: str) -> Column:
        return F.sum(F.col(s) + F.col("n") * F.col(a) * F.col(b)).alias(s)

    def noise(raw: str, mean: str, apart: str) -> Column:
        from_zero = F.col("n") * F.col(mean) * F.col(mean)
        return F.sum(NOISE * (F.col(raw) + F.col("n") * F.col(apart) * F.col(apart)) + GRAIN * from_zero)

    size = noise("rxx", "mx", "dmx").alias("xx"), noise("ryy", "my", "dmy").alias("yy")
    return centred.groupBy("i", "j").agg(
        F.sum("n").alias("n"), whole("sxx", "dmx", "dmx"), whole("syy", "dmy", "dmy"), whole("sxy", "dmx", "dmy"), *size
    )


def _spread(square: str, noise: str) -> Column:
    return F.when(F.col(square) > F.col(noise), F.col(square))


def _pair_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every pair (i <= j) of columns, also one without rows."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(len(columns)) for j in range(i, len(columns))])
    return df.sparkSession.range(1).select(F.inline(pairs))


def pairwise_correlation(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """Each unordered pair once, (col_a, col_b, corr) with col_a at or before col_b.

    NULL where the rows with both values are fewer than two or one side is constant.
    """
    corr = F.try_divide(F.col("sxy"), F.sqrt(_spread("sxx", "xx")) * F.sqrt(_spread("syy", "yy")))
    names = F.array(*[F.lit(c) for c in columns])
    # One row per pair on either side.
    found = _pair_numbers(df, columns).join(F.broadcast(pair_sums(df, columns)), ["i", "j"], "left")
    return found.select(
        F.get(names, F.col("i")).alias("col_a"),
        F.get(names, F.col("j")).alias("col_b"),
        F.round(corr, digits).alias("corr"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """The square matrix: one row per column of the input."""
    upper = pairwise_correlation(df, columns, digits)
    # Both triangles come from the one row of a pair.
    both = F.array(F.struct(F.col("col_a").alias("column"), F.col("col_b").alias("other")), F.struct(F.col("col_b").alias("column"), F.col("col_a").alias("other")))
    return (
        upper.select("corr", F.inline(both))
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("other") == c, F.col("corr"))).alias(c) for c in columns])
    )


def top_correlations(
    df: DataFrame, columns: Sequence[str], digits: int = DIGITS, limit: int = TOP_PAIRS
) -> DataFrame:
    """The pairs of different columns with the strongest correlation, each pair once."""
    pairs = pairwise_correlation(df, columns, digits).filter("col_a <> col_b")
    return (
        pairs.filter("corr is not null")
        .withColumn("abs_corr", F.abs("corr"))
        .orderBy(F.desc("abs_corr"), "col_a", "col_b")
        .limit(limit)
    )
