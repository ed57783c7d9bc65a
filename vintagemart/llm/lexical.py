"""Ranked lexical search by best positions.

A term's impact list holds the documents that have it, by falling impact.  The
lists of a query are read in rounds, from the top of each.  A document met for the
first time is looked up in all other lists of the query by direct access, which gives its
score and marks its place in each list as seen.  A list's best position is the last
one up to which every place is seen; it is at least as deep as the place last read.
No document that was not met can score more than the impacts at the best positions
together.  Reading stops once that is strictly below the k-th best score so far, so
that ties are never lost.

Documents are dealt over tasks as they are stored; nothing is shuffled by term.  A
first pass counts the queries' terms in every document and writes them; from it come
the statistics of the corpus.  A second pass builds the impact lists of a segment
of documents at a time and answers all queries on it.  The k-th best score of a query is carried
from segment to segment, so most of a later segment need not be read.  Tasks return
k documents a query; these are merged in groups of tasks, then over all.

Queries are taken in blocks of about ``BLOCK_TERMS`` terms, which bounds what is
broadcast: their terms, weights and lists.

Defined results: a null or empty text has no terms.  Every row of the documents counts by
itself, also where rows are equal; rows without an id come last among equal scores.  Queries
of one id are one query with the terms of all its texts.  Without documents or without
terms in common there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import written
from .text import blocks

# A term as a pattern, and the same as a table of bytes, A to Z lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _LETTERS else 0x20 for b in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

K = 50

# Terms of a block of queries, postings of a segment, and tasks whose results are merged first.
BLOCK_TERMS = 200_000
SEGMENT_POSTINGS = 2_000_000
MERGED_TASKS = 256

# Places read from each list in the first round; later rounds read twice as many as the one before.
FIRST_ROUND = 32


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def term_weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Segment:
    """Impact lists of some documents, and for each posting of a document its place in its list."""

    def __init__(self, ids: np.ndarray, nameless: np.ndarray, counts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.ids, self.nameless = ids, nameless
        self.doc_ends = np.cumsum(counts)
        self.doc_starts = self.doc_ends - counts
        doc = np.repeat(np.arange(len(ids)), counts)
        order = np.lexsort((-impacts, terms))
        self.terms, self.impacts = terms, impacts
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))
        self.list_docs, self.list_impacts = doc[order], impacts[order]
        self.list_starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        # Used by one query at a time and cleared after it.
        self.seen = np.zeros(len(order), dtype=bool)
        self.met = np.zeros(len(ids), dtype=bool)
        self.asked = np.zeros(n_terms, dtype=bool)

    def search(self, query: np.ndarray, best: "Best", k: int) -> int:
        """Put the query's best documents of the segment among its best so far; how many were met."""
        starts, stops = self.list_starts[query], self.list_starts[query + 1]
        some = stops > starts
        query, starts, stops = query[some], starts[some], stops[some]
        positions = starts.copy()
        self.asked[query] = True
        touched, documents = [], []
        depth, step = 0, FIRST_ROUND
        while True:
            # An exhausted list adds nothing to a document that was not met.
            open_ = positions < stops
            if not open_.any() or int(self.list_impacts[positions[open_]].sum()) < best.least(k):
                break
            first = np.minimum(starts + depth, stops)
            read = _ranges(first, np.minimum(first + step, stops) - first)
            depth, step = depth + step, step * 2
            fresh = self.list_docs[read]
            fresh = np.unique(fresh[~self.met[fresh]])
            if len(fresh):
                self.met[fresh] = True
                documents.append(fresh)
                lengths = self.doc_ends[fresh] - self.doc_starts[fresh]
                postings = _ranges(self.doc_starts[fresh], lengths)
                mine = self.asked[self.terms[postings]]
                totals = np.append(0, np.cumsum(np.where(mine, self.impacts[postings], 0)))
                ends = np.cumsum(lengths)
                places = self.place[postings[mine]]
                self.seen[places] = True
                touched.append(places)
                best.add(totals[ends] - totals[ends - lengths], self.ids[fresh], self.nameless[fresh], k)
            positions = np.array([self._best_position(p, s) for p, s in zip(positions.tolist(), stops.tolist())], dtype=np.int64)
        self.asked[query] = False
        for places in touched:
            self.seen[places] = False
        for fresh in documents:
            self.met[fresh] = False
        return sum(map(len, documents))

    def _best_position(self, position: int, stop: int) -> int:
        """The first place from the position on that was not seen."""
        size = 64
        while position < stop:
            part = self.seen[position : min(position + size, stop)]
            first = int(part.argmin())
            if not part[first]:
                return position + first
            position, size = position + len(part), size * 4
        return stop


class Best:
    """The best documents of one query so far."""

    def __init__(self):
        self.scores = self.ids = np.empty(0, dtype=np.int64)
        self.nameless = np.empty(0, dtype=bool)

    def least(self, k: int) -> int:
        """What a document must reach to be among them; scores are above 0."""
        return int(self.scores[-1]) if len(self.scores) == k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray, k: int) -> None:
        good = scores >= self.least(k)
        scores = np.append(self.scores, scores[good])
        ids, nameless = np.append(self.ids, ids[good]), np.append(self.nameless, nameless[good])
        order = np.lexsort((ids, nameless, -scores))[:k]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


def _counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with a term: how many it has, and its counts of the numbered ones."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for rows, texts in blocks(batches, "text"):
            lengths, ends, terms, counts = [], [0], [], []
            for text in texts:
                words = (text or "").encode().translate(_TO_TERMS).split()
                found = Counter(map(number, words))
                found.pop(None, None)
                lengths.append(len(words))
                terms += found.keys()
                counts += found.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in (terms, counts)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lengths, pa.int64()), *lists], names=["id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "id long, n long, terms array<int>, counts array<int>").where("n > 0")


def _segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows put together to tables of about so many postings."""
    held, postings = [], 0
    for batch in batches:
        ends = np.cumsum(np.diff(batch.column(2).offsets.to_numpy()))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + most - postings, side="right")))
            held.append(batch.slice(start, stop - start))
            postings += int(ends[stop - 1]) - base
            base, start = int(ends[stop - 1]), stop
            if postings >= most or start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, postings = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _answer(docs: DataFrame, queries: list[tuple], weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """The best documents of every query, by task."""
    shared = docs.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = shared.value
        found = [Best() for _ in asked]
        for table in _segments(batches, SEGMENT_POSTINGS):
            id_, n, terms, counts = (table.column(i).combine_chunks() for i in range(4))
            per_doc = np.diff(terms.offsets.to_numpy())
            nameless = id_.is_null().to_numpy(zero_copy_only=False)
            m = 50 + (50 * n.to_numpy().astype(np.int64) * documents) // length
            term, tf = terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64)
            impacts = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, per_doc)))
            segment = Segment(id_.fill_null(0).to_numpy(), nameless, per_doc, term, impacts, len(weight))
            for (_, query), best in zip(asked, found):
                segment.search(query, best, k)
        for (item, _), best in zip(asked, found):
            if len(best.ids):
                ids = pa.array(best.ids, pa.int64(), mask=best.nameless)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), pa.int64()), ids, pa.array(best.scores)], names=["item_id", "doc_id", "score"]
                )

    return docs.mapInArrow(run, "item_id long, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    k: int = K,
) -> DataFrame:
    """Per query its k best documents with a score above 0: (item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    items = items.select(F.col(item_column).cast("long").alias("item"), F.explode(terms_of(F.col(item_text_column))).alias("term"))
    items = written(items.distinct(), "query_terms")
    n_blocks = max(1, math.ceil(items.count() / BLOCK_TERMS))
    found = []
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block)
        queries = mine.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
        names = sorted({t for q in queries for t in q.terms})
        numbers = {t.encode(): i for i, t in enumerate(names)}
        counted = written(_counted(docs, numbers), "query_counts")
        totals = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        having = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(names), dtype=np.int64)
        for row in having:
            weights[row.term] = term_weight(totals.documents, row["count"])
        asked = [(q.item, np.array([numbers[t.encode()] for t in q.terms], dtype=np.int64)) for q in queries]
        found.append(_answer(counted, asked, weights, totals.documents, totals.length or 1, k))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    tasks = Window.partitionBy("item_id", F.floor(F.spark_partition_id() / MERGED_TASKS)).orderBy(*order)
    best = best.withColumn("place", F.row_number().over(tasks)).where(F.col("place") <= k)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
