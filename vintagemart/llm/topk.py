"""Exact top-k search by inner product with MaxScore.

Dimensions are the terms and components the impacts.  Candidates are split into
shards; a shard keeps one posting list per dimension and its largest and
smallest impact.  For a query, dimensions are ordered by the most they can add to
any candidate's score.  Candidates are taken in chunks.  The first chunk is scored in full; from then on
there is a k-th score, which rises from chunk to chunk.  Dimensions at the end
whose bounds together cannot lift a candidate over it are non-essential: the lists of the others
are traversed for all candidates of a chunk, and only candidates that stay competitive are
probed in the rest.  Each shard returns its k best, and the shards' lists are
merged.

Queries are all rows whose id is divisible by ``every``.  They meet the shards in
blocks: one task has one shard and one block of queries.  Shards and blocks are as large as
a task's memory allows (``SHARD_BYTES``, ``QUERY_BYTES``), since every query goes to every shard and every
candidate to every block; there are more of them only as long as there are fewer than tasks that run at once.
Rows are numbered and written once, and dealt by their numbers, so that rows of one id spread.

Defined results: components are turned into floor(scale * x), at most the largest whole number of 64
bits and at least the smallest; vectors that are
null, empty, or hold null or non-finite components take no part, nor do rows
without an id.  Shorter vectors count as if filled up with zeros.  A query's own
row is left out, another row with the same id is not.  Scores are exact whole numbers; one that
does not fit 64 bits counts as the largest or smallest such number.  Ties go to the smaller id.  An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import written

# Bytes of the vectors of a shard and of a block of queries, as doubles; and the fewest rows worth a shard of their own.
SHARD_BYTES, QUERY_BYTES = 24 << 20, 8 << 20
LEAST_ROWS = 4096

# Candidates of the first chunk, which is scored in full, and of later ones.
FIRST_ROWS, CHUNK_ROWS = 256, 4096

SCALE = 256
EVERY = 50
K = 5

# Sums of products stay exact in a double below the first; the largest whole number of 64 bits.
EXACT, LONGEST = 2**53, 2**63 - 1


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    # Within 64 bits, also where a large component times the scale is no longer finite.
    scaled = F.transform(vector, lambda x: F.greatest(F.lit(-(2.0**63)), F.least(F.lit(2.0**63), F.lit(float(scale)) * x.cast("double"))))
    whole = F.transform(scaled, lambda x: F.when(x >= 2.0**63, F.lit(LONGEST)).otherwise(F.floor(x)))
    return F.when(good & (F.size(vector) > 0), whole)


class Shard:
    """The candidates of one shard as posting lists, one row per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.place = {row: at for at, row in enumerate(rows[order].tolist())}
        self.ids, self.lists = ids[order], np.ascontiguousarray(vectors[order].T)
        self.most, self.least = self.lists.max(axis=1), self.lists.min(axis=1)

    def search(self, row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates but the query's own row."""
        own, n = self.place.get(row, -1), len(self.ids)
        bounds = np.maximum(query * self.most, query * self.least)
        order = np.argsort(-bounds, kind="stable")
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        places, scores, least = np.empty(0, dtype=np.int64), query[:0], None
        start = 0
        while start < n:
            stop = min(n, start + (CHUNK_ROWS if start else FIRST_ROWS))
            found, total = self._competitive(np.arange(start, stop), query, order, rest, least)
            if total.dtype == object:
                total = np.minimum(np.maximum(total, -LONGEST - 1), LONGEST)
            if own >= 0:
                found, total = found[found != own], total[found != own]
            places, scores = np.append(places, found), np.append(scores, total)
            best = np.lexsort((self.ids[places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(scores) == k:
                least = scores[-1]
            start = stop
        return self.ids[places], scores

    def _competitive(self, alive: np.ndarray, query: np.ndarray, order: np.ndarray, rest: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
        """Of neighbouring candidates those that reach the k-th score so far, with their scores."""
        span = slice(int(alive[0]), int(alive[-1]) + 1)
        if least is None:
            return alive, query @ self.lists[:, span]
        # Essential: as many dimensions as it takes until the others cannot add what is missing
        # to a candidate without any score; their lists are traversed for all candidates.
        essential = max(1, int(np.argmax(rest < least)) if least > 0 else len(order) // 2)
        chosen = order[:essential]
        total = query[chosen] @ self.lists[chosen, span]
        whole, step = len(alive), essential
        while step < len(order):
            keep = total + rest[step] >= least
            if not keep.all():
                alive, total = alive[keep], total[keep]
            probe = order[step : step + 8]
            total = total + query[probe] @ (self.lists[probe, span] if len(alive) == whole else self.lists[np.ix_(probe, alive)])
            step += 8
        keep = total >= least
        return alive[keep], total[keep]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.combine_chunks()
    lengths = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(rows), width), dtype=np.int64)
    out[np.repeat(np.arange(len(rows)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _largest(numbers: np.ndarray) -> int:
    return max(int(numbers.max()), -int(numbers.min()))


def _best(k: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """The k best candidates of a shard (left) for a block of queries (right)."""
    out: dict[str, list] = {"query_id": [], "row": [], "vec_id": [], "score": []}
    if left.num_rows and right.num_rows:
        width = max(pc.max(pc.list_value_length(t.column("vector"))).as_py() for t in (left, right))
        candidates, queries = _matrix(left.column("vector"), width), _matrix(right.column("vector"), width)
        # Doubles as long as they are exact; beyond, which is rare, whole numbers of any size.
        exact = _largest(candidates) * _largest(queries) * width < EXACT
        candidates, queries = (m.astype(np.float64 if exact else object) for m in (candidates, queries))
        shard = Shard(left.column("vec_id").to_numpy(), left.column("row").to_numpy(), candidates)
        for id_, row, query in zip(right.column("vec_id").to_pylist(), right.column("row").to_pylist(), queries):
            found, scores = shard.search(row, query, k)
            out["query_id"] += [id_] * len(found)
            out["row"] += [row] * len(found)
            out["vec_id"] += found.tolist()
            out["score"] += [int(s) for s in scores]
    return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))


def top_k(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = EVERY,
    k: int = K,
    scale: int = SCALE,
    shard_rows: int | None = None,
    query_block: int | None = None,
) -> DataFrame:
    """Per query its k highest scores: (query_id, rank, vec_id, score)."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), whole_numbers(F.col(vector_column), scale).alias("vector"))
    rows = rows.where("vec_id is not null and vector is not null")
    # Written, so that every later read sees the same number on a row.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q"), F.max(F.size("vector")).alias("width")).first()
    width = 8 * (counts.width or 1)
    query_blocks = max(1, math.ceil(counts.q / (query_block or max(1, QUERY_BYTES // width))))
    shards = max(1, math.ceil(counts.n / (shard_rows or max(1, SHARD_BYTES // width))))
    if shard_rows is None:
        at_once = math.ceil(vectors.sparkSession.sparkContext.defaultParallelism / query_blocks)
        shards = max(shards, min(at_once, math.ceil(counts.n / LEAST_ROWS)))
    candidates = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("block"),
        "row",
        "vec_id",
        "vector",
    )
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("row", F.lit(1)), F.lit(query_blocks)).cast("int").alias("block"),
        "row",
        "vec_id",
        "vector",
    )
    found = candidates.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(
        lambda left, right: _best(k, left, right), "query_id long, row long, vec_id long, score long"
    )
    # Each query has at most k rows from every shard.
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
