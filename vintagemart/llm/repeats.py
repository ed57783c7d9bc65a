"""Removal of passages that occur elsewhere, by prefix-partitioned suffix trees.

A window of ``width`` words that also starts somewhere else is a maximal repeat, or a part of one, of at
least that many words: a path to an internal node of the suffix tree of all texts.  The tree is never built
whole.  It is sparse, split by prefixes, and each subtree is resolved by itself:

* Only suffixes that begin at an anchor are kept.  A window's anchor is the smallest of its runs of
  ``gram`` words (by a hash, the leftmost of equal ones), so equal windows have it at the same place, and
  neighbouring windows share it.  A row stands for the windows around one anchor, and holds their words.
* The anchor's ``gram`` words are the prefix that suffixes are split by.  A prefix that occurs once is a
  leaf and is not moved; fixed bits tell which may occur twice.  A prefix that
  more than ``GROUP_RUNS`` rows share, whose subtree could outgrow a task, is extended to the whole window.  Both
  are decided beforehand, from the counts of all prefixes of all texts.
* A task builds the subtrees of its prefixes level by level, word by word: a node holds the anchors whose
  next words are equal, and leaves are dropped.  In the same way it builds the tree of the words before
  the anchors.  A window with ``o`` words before its anchor is repeated where two anchors share a node of depth ``o``
  there and one of depth ``width - o`` here.
* A task first resolves what repeats within its own block of texts, and ships one
  of the equal windows only, so a passage that stands in every document crosses
  the network once per block.

Windows of different blocks are compared word by word.  Within a block they are held equal if two
independent 64-bit hashes of theirs are equal, and the place of the anchor.

Defined results: a null or empty text has no words, nothing removed and an empty
rest; texts shorter than a window are left alone.  A repeated row is a repetition
of its text; the runs of equal rows are put together before they are shuffled, so that each run
is there once, however many rows are equal.  The order of words that stay is kept.  Extra columns are
ignored.  An empty table gives no rows.  A very long text is a block by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import written
from .text import blocks, words_of

# Words of a window and of the prefix that suffixes are split by.
WIDTH = 35
GRAM = 8

# A prefix that more rows than this share is extended.  There is at most one such prefix for so many
# rows, of about 14 windows each, so the list of them is a millionth of the text or less.
GROUP_RUNS = 20_000

# Rows of one extended prefix, all of the same window, that a task holds before it keeps one of them.
HELD_ROWS = 50_000

# Bits that tell which prefixes may occur twice.  Their number is fixed: with many more such prefixes
# than bits more rows are moved in vain, never too few.  Fixed value: bits of one of Spark's bitmaps.
FILTER_BITS = 1 << 27
BITMAP_BITS = 1 << 15

# Bytes of text resolved within a task before anything is shipped.
BLOCK = 4 << 20

# Odd multipliers of the hashes.
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def words_in(texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes, where words start and end in them, and how many words each text has."""
    encoded = [(t or "").encode() for t in texts]
    ends_at = np.cumsum([len(e) + 1 for e in encoded])
    joined = b" ".join(encoded) + b" "
    space = _IS_SPACE[np.frombuffer(joined, dtype=np.uint8)]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    return joined, starts, ends, np.diff(np.append(0, np.searchsorted(starts, ends_at)))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of all texts, in order, and how many words each text has."""
    joined, starts, ends, counts = words_in(texts)
    return _hashed(np.frombuffer(joined, dtype=np.uint8), starts, ends), counts


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    # Eight bytes at a time: words are mostly shorter than two such steps.
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    value = np.zeros(len(starts), dtype=np.uint64)
    length = ends - starts
    step, left = 0, np.arange(len(starts))
    while len(left):
        at = starts[left] + step
        chunk = np.zeros(len(left), dtype=np.uint64)
        rest = length[left] - step
        for i in range(8):
            byte = padded[at + i].astype(np.uint64)
            chunk |= np.where(i < rest, byte, np.uint64(0)) << np.uint64(8 * i)
        value[left] = mixed((value[left] + M1) * M2 ^ chunk)
        step += 8
        left = left[rest > 8]
    return mixed(value + length.astype(np.uint64) * M1)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` neighbours."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        out *= M1
        out += hashes[i : i + n]
    return mixed(out)


class Block:
    """The windows of a block of texts, with the prefix each of them is known by."""

    def __init__(self, texts: list[str | None], width: int, gram: int):
        self.text, self.starts, self.ends, counts = words_in(texts)
        words = _hashed(np.frombuffer(self.text, dtype=np.uint8), self.starts, self.ends)
        owner = np.repeat(np.arange(len(texts)), counts)
        first = np.cumsum(counts) - counts
        self.window = np.empty(0, dtype=np.uint64)
        self.owner = self.place = self.offset = self.word = np.empty(0, dtype=np.int64)
        self.width = width
        self.gram = self.window
        if len(words) < width:
            return
        grams = rolled(words, gram)
        span = width - gram + 1
        # The high half of the hash decides, then the place: the leftmost of the smallest.
        ranked = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
        reach, least = 1, ranked
        while 2 * reach <= span:
            least = np.minimum(least[: len(least) - reach], least[reach:])
            reach *= 2
        if reach < span:
            least = np.minimum(least[: len(ranked) - span + 1], least[span - reach : span - reach + len(ranked) - span + 1])
        inside = np.flatnonzero(owner[: len(words) - width + 1] == owner[width - 1 :])
        anchor = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.window = rolled(words, width)[inside]
        self.gram = grams[anchor]
        self.offset = anchor - inside
        self.owner = owner[inside]
        self.place = inside - first[self.owner]
        self.word = inside

    def runs(self, chosen: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of neighbouring chosen windows begin and how long they are, cut where ``same`` changes."""
        if not len(chosen):
            return chosen, chosen
        new = np.append(True, (np.diff(self.place[chosen]) != 1) | (np.diff(self.owner[chosen]) != 0))
        for values in same:
            new[1:] |= values[chosen][1:] != values[chosen][:-1]
        begins = np.flatnonzero(new)
        return begins, np.diff(np.append(begins, len(chosen)))

    def words_of(self, begins: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The text of runs of windows, as it stands there."""
        first = self.word[begins]
        spans = zip(self.starts[first].tolist(), self.ends[first + lengths + self.width - 2].tolist())
        return [self.text[a:b] for a, b in spans]


def prefixes(docs: DataFrame, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes to extend, sorted, and bits of those that may occur twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, "text", BLOCK):
            block = Block(texts, width, gram)
            begins, _ = block.runs(np.arange(len(block.window)), block.gram, block.place + block.offset)
            grams, n = np.unique(block.gram[begins] if len(begins) else block.gram, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    found = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = written(found.where("n > 1"), "prefixes")
    hot = counts.where(F.col("n") > GROUP_RUNS).select("gram").collect()
    slot = counts.select((F.pmod("gram", F.lit(FILTER_BITS)) + 1).alias("slot"))
    maps = slot.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros((-(-FILTER_BITS // BITMAP_BITS), BITMAP_BITS // 8), dtype=np.uint8)
    # The maps have a fixed size together and come piece by piece.
    for row in maps.toLocalIterator():
        bits[row.bucket - 1] = np.frombuffer(row.bits, dtype=np.uint8)
    return np.sort(np.array([r.gram for r in hot], dtype=np.int64).view(np.uint64)), bits.ravel()


def _may_occur_twice(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = (grams.view(np.int64) % FILTER_BITS).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _equal(*numbers: np.ndarray) -> np.ndarray:
    """A code for each row of numbers, equal exactly where all its numbers are."""
    codes, uniques = pd.factorize(numbers[0])
    for more in numbers[1:]:
        first = np.empty(len(uniques), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if (more == more[first[codes]]).all():
            continue
        # Rare: equal numbers of different windows.
        others, n = pd.factorize(more)
        codes, uniques = pd.factorize(codes * len(n) + others)
    return codes


SUFFIXES = "key long, row long, row2 long, first int, n int, offset int, words binary"


def _suffixes(batches: Iterator[pa.RecordBatch], hot: np.ndarray, bits: np.ndarray, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Runs known to be repeated (without a key), and the windows around anchors, to be resolved by prefix."""
    for rows, texts in blocks(batches, "text", BLOCK):
        block = Block(texts, width, gram)
        if not len(block.window):
            continue
        ids = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(2)]
        codes = _equal(block.window, block.gram, block.offset)
        repeated = np.bincount(codes)[codes] > 1
        first = np.zeros(len(codes), dtype=bool)
        first[np.unique(codes, return_index=True)[1]] = True
        known = np.flatnonzero(repeated)
        begins, lengths = block.runs(known)
        yield _rows(None, ids, block, known[begins], lengths)
        # A prefix may occur twice here, too, with windows that differ.
        shipped = np.flatnonzero(first & _may_occur_twice(block.gram, bits))
        at = np.minimum(np.searchsorted(hot, block.gram[shipped]), max(0, len(hot) - 1))
        extended = hot[at] == block.gram[shipped] if len(hot) else np.zeros(len(shipped), dtype=bool)
        plain = shipped[~extended]
        begins, lengths = block.runs(plain, block.gram, block.place + block.offset)
        yield _rows(block.gram[plain[begins]], ids, block, plain[begins], lengths)
        long = shipped[extended]
        yield _rows(mixed(block.window[long]), ids, block, long, np.ones(len(long), dtype=np.int64))


def _rows(key, ids, block: Block, begins: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    n = len(begins)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.int64()) if key is None else pa.array(key.view(np.int64)),
            *[pa.array(i[block.owner[begins]]) for i in ids],
            pa.array(block.place[begins].astype(np.int32)),
            pa.array(lengths.astype(np.int32)),
            pa.array(block.offset[begins].astype(np.int32)),
            pa.nulls(n, pa.binary()) if key is None else pa.array(block.words_of(begins, lengths), pa.binary()),
        ],
        names=["key", "row", "row2", "first", "n", "offset", "words"],
    )


def _resolve(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows, from rows sorted by key; a key's rows are taken together."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch.column(0)
        marks = batch.filter(keys.is_null())
        if marks.num_rows:
            yield marks.select(["row", "row2", "first", "n"])
        batch = batch.filter(keys.is_valid())
        if not batch.num_rows:
            continue
        values = batch.column(0).to_numpy()
        # What belongs to the keys before the last one of this batch is complete.
        cut = int(np.searchsorted(values, values[-1], side="left"))
        if waiting and (cut or last != values[-1]):
            yield _repeated([*waiting, batch.slice(0, cut)], width)
            waiting = []
        elif cut:
            yield _repeated([batch.slice(0, cut)], width)
        waiting.append(batch.slice(cut))
        last = values[-1]
        if sum(b.num_rows for b in waiting) > HELD_ROWS:
            # Rows of an extended prefix: nearly all are the same window, and one of them stands for it.
            yield _repeated(waiting, width)
            table = pa.Table.from_batches(waiting).combine_chunks()
            seen = pa.chunked_array([pa.array(_single_blanks(table.column("words").to_pylist()), pa.binary())])
            places = np.unique(seen.combine_chunks().dictionary_encode().indices.to_numpy(), return_index=True)[1]
            waiting = table.take(pa.array(np.sort(places))).combine_chunks().to_batches()
    if waiting:
        yield _repeated(waiting, width)


def _single_blanks(texts: list[bytes]) -> list[bytes]:
    return [b" ".join(t.split()) for t in texts]


class Subtrees:
    """The windows around anchors with equal prefixes, and the trees of the words behind and before the anchors.

    ``after[d]`` and ``before[d]`` hold the node of depth ``d`` each anchor is below, -1 where that is a
    leaf or the row's words end before.
    """

    def __init__(self, keys: np.ndarray, offsets: np.ndarray, counts: np.ndarray, texts: list[bytes], width: int):
        split = [t.split() for t in texts]
        words = pa.array([w for ws in split for w in ws], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        start = np.cumsum(lengths) - lengths
        self.width, self.offsets, self.counts = width, offsets, counts
        anchor, root = start + offsets, pd.factorize(keys)[0]
        # A row's windows have from `least` to `offsets` words before the anchor.
        self.least = offsets - counts + 1
        self.after = self._levels(words, root, anchor, 1, width - self.least)
        self.before = self._levels(words, root, anchor - 1, -1, offsets)

    @staticmethod
    def _levels(words: np.ndarray, root: np.ndarray, first: np.ndarray, step: int, deepest: np.ndarray) -> list[np.ndarray]:
        levels = [root]
        total = int(words.max()) + 1 if len(words) else 1
        for depth in range(1, int(deepest.max(initial=0)) + 1):
            node = np.full(len(root), -1, dtype=np.int64)
            alive = np.flatnonzero((levels[-1] >= 0) & (deepest >= depth))
            if len(alive):
                found, _ = pd.factorize(levels[-1][alive] * total + words[first[alive] + step * (depth - 1)])
                inner = np.bincount(found)[found] > 1
                node[alive[inner]] = found[inner]
            levels.append(node)
        return levels

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows and places of windows that occur more than once."""
        rows, places = [], []
        for before in range(int(self.offsets.max(initial=-1)) + 1):
            after = self.width - before
            if after >= len(self.after) or before >= len(self.before):
                continue
            here = np.flatnonzero((self.least <= before) & (before <= self.offsets) & (self.after[after] >= 0) & (self.before[before] >= 0))
            if not len(here):
                continue
            both, _ = pd.factorize(self.after[after][here] * len(self.offsets) + self.before[before][here])
            twice = here[np.bincount(both)[both] > 1]
            rows.append(twice)
            places.append(self.offsets[twice] - before)
        if not rows:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        row, place = np.concatenate(rows), np.concatenate(places)
        order = np.lexsort((place, row))
        return row[order], place[order]


def _repeated(parts: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    key, row, row2, first, n, offset = (table.column(i).to_numpy() for i in range(6))
    # Rows whose key occurs once have nothing to be equal to.
    alone = np.append(True, key[1:] != key[:-1]) & np.append(key[1:] != key[:-1], True)
    keep = np.flatnonzero(~alone)
    key, row, row2, first, n, offset = (x[keep] for x in (key, row, row2, first, n, offset))
    texts = table.column(6).take(pa.array(keep)).to_pylist()
    which, place = Subtrees(key, offset.astype(np.int64), n.astype(np.int64), texts, width).repeated()
    new = np.append(True, (np.diff(place) != 1) | (np.diff(which) != 0))[: len(which)]
    begins = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row[which[begins]]),
            pa.array(row2[which[begins]]),
            pa.array((first[which[begins]] + place[begins]).astype(np.int32)),
            pa.array(np.diff(np.append(begins, len(which))).astype(np.int32)),
        ],
        names=["row", "row2", "first", "n"],
    )


def covered(n_words: int, marks, width: int) -> np.ndarray:
    """Whether each word lies in a window of the marked runs (first window, number of windows)."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    for first, n in marks:
        steps[first] += 1
        steps[first + n + width - 1] -= 1
    return np.cumsum(steps)[:-1] > 0


ROW = ["row", "row2"]


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id and text, and two numbers that tell the row from all that differ from it."""
    id_, text = F.col(id_column), F.col(text_column)
    return docs.select(id_.alias("id"), text.alias("text"), F.xxhash64(id_, text).alias("row"), F.xxhash64(F.lit(1), text, id_).alias("row2"))


def repeated_runs(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per row (two hashes of id and text) the runs of windows that occur elsewhere: (row, row2, runs)."""
    keyed = _keyed(docs, id_column, text_column)
    # One number for each GROUP_RUNS rows at most, and FILTER_BITS bits.
    shared = docs.sparkSession.sparkContext.broadcast(prefixes(keyed, width, gram))
    shipped = keyed.select(*ROW, "text").mapInArrow(lambda batches: _suffixes(batches, *shared.value, width, gram), SUFFIXES)
    # Runs that need no other task go anywhere; suffixes of a key go together.
    sorted_ = shipped.repartition(F.coalesce("key", F.xxhash64("row", "first"))).sortWithinPartitions("key")
    marks = sorted_.mapInArrow(lambda batches: _resolve(batches, width), "row long, row2 long, first int, n int")
    # Equal rows have equal runs: the longest from each place is kept, on the map side already.
    longest = marks.groupBy(*ROW, "first").agg(F.max("n").alias("n"))
    return longest.groupBy(*ROW).agg(F.collect_list(F.struct("first", "n")).alias("runs"))


def remove_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Number of words, number removed and the words that stay, joined by a blank, for every document."""
    keyed = _keyed(docs, id_column, text_column)
    runs = repeated_runs(docs, id_column=id_column, text_column=text_column, width=width, gram=gram)
    kind = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, "text", BLOCK):
            n, removed, kept = [], [], []
            for text, marks in zip(texts, rows.column(rows.schema.get_field_index("runs")).to_pylist()):
                words = words_of(text)
                gone = covered(len(words), [(m["first"], m["n"]) for m in marks], width) if marks else None
                left = words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g]
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    joined = keyed.join(runs, ROW, "left").select("id", "text", "runs")
    return joined.mapInArrow(cut, f"id {kind}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_column)
