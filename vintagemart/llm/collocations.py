"""Collocations: phrases whose words stand together more often than their parts suggest.

Counts are kept as sorted streams, as in the estimation of n-gram models on disk.
Every place of a word gives one window, the word and up to three that follow it in
its piece; that is one row for all lengths of phrase that start there.  Tasks turn
a block of texts into its windows in order, equal ones counted once, and cut the
stream at the bounds of ranges.  A range merges the streams of all blocks: in
prefix order the windows of a phrase stand together, so a running sum gives the
counts of phrases of every length at once.  Only the first and last phrases of a
range can go on in another one; their parts are added up.

The counts of frequent phrases are then joined with themselves in lockstep, by sort-merge
joins: in prefix order with the part before a cut, in suffix order with the part after it, and
with the counts of phrases longer by one word at either end.  Every part of a candidate is
at least as frequent as the candidate, and among the longer candidates around a phrase the
most frequent is longer by one word, so nothing rarer is ever looked up.

Ranges are cut at windows of a sample of texts, which decides their sizes but no
count; there is one per ``RANGE_BYTES`` of text.

Defined results: null texts have no words, a null language is ``und``.  Repeated rows
count as often as they stand there.  Scores and shares are computed in decimals of 38 digits.
An empty table has no phrases.  A very long text is one block.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import written
from .text import blocks

# Fixed values of the measure.
LONGEST = 4
LEAST_COUNT = 30
SCORE_SCALE = 2_000_000
LONGER_PERCENT = 80
MOST_PER_LANG = 2000
NO_LANG = "und"

# Text that is put in order at once, and text whose windows make one range.
BLOCK = 8 << 20
RANGE_BYTES = 6 << 20

# Sample that the bounds of ranges are taken from: at least so much text, so much of it and so many windows a range.
SAMPLE_BYTES = 8 << 20
SAMPLE_A_RANGE = 8 << 10
BOUNDS_FROM = 64

# Groups that the phrases of one language are first ranked in.
RANK_GROUPS = 256

# Bytes that part words, and bytes that end a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class Windows:
    """Windows in order, each with its count.

    ``columns`` are the number of the language and those of the words, 0 where a
    window has no further word; numbers follow the order of the names.
    """

    def __init__(self, langs: list[str], words: pa.Array, columns: list[np.ndarray], counts: np.ndarray):
        self.langs, self.words = langs, words
        sizes = [max(1, len(langs)), *[len(words) + 1] * (len(columns) - 1)]
        self.columns, self.counts = _merged(columns, sizes, counts)

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, row: int) -> tuple:
        """A window as language and words, which compare as windows do."""
        numbers = [int(c[row]) for c in self.columns[1:]]
        return (self.langs[self.columns[0][row]].encode(), *[self.words[n - 1].as_py() for n in numbers if n])

    def pack(self, start: int, stop: int) -> dict:
        """The rows from start to stop, with the words they have."""
        used = np.zeros(len(self.words) + 1, dtype=bool)
        for column in self.columns[1:]:
            used[column[start:stop]] = True
        used[0] = True
        number = np.cumsum(used) - 1
        codes = [self.columns[0][start:stop], *[number[c[start:stop]] for c in self.columns[1:]]]
        words = self.words.take(pa.array(np.flatnonzero(used[1:])))
        return {
            "langs": json.dumps(self.langs),
            "words": _squeeze(b" ".join(words.to_pylist())),
            "codes": _squeeze(np.concatenate(codes).astype(np.int32).tobytes()),
            "counts": _squeeze(self.counts[start:stop].astype(np.int64).tobytes()),
        }


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _expand(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _merged(columns: list[np.ndarray], sizes: list[int], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows in order, equal ones as one with the sum of their counts."""
    if not len(counts):
        return columns, counts
    key, size = columns[0].astype(np.int64), sizes[0]
    for column, n in zip(columns[1:], sizes[1:]):
        if size * n >= 1 << 62:
            uniques, key = np.unique(key, return_inverse=True)
            size = len(uniques)
        key, size = key * n + column, size * n
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return [c[order[first]] for c in columns], np.add.reduceat(counts[order], first)


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in order, and the place of each word among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def windows_of(texts: list[str | None], langs: list[str | None], longest: int = LONGEST) -> Windows:
    """The windows of a block of texts."""
    names = sorted({NO_LANG if lang is None else lang for lang in langs}, key=str.encode)
    number = {name: i for i, name in enumerate(names)}
    encoded = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", dtype=np.uint8)
    kind = _KIND[data]
    word = kind == 0
    edges = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    piece = np.cumsum(kind == 2, dtype=np.int64)[starts]
    text_ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), dtype=np.int64, count=len(encoded)))
    lang = np.fromiter((number[NO_LANG if v is None else v] for v in langs), dtype=np.int64, count=len(langs))
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[word].tobytes())])
    words, place = _ranked(found)
    columns = [lang[np.searchsorted(text_ends, starts, side="right")].astype(np.int32)]
    for shift in range(longest):
        column = np.zeros(len(starts), dtype=np.int32)
        if shift < len(starts):
            column[: len(starts) - shift] = np.where(piece[shift:] == piece[: len(starts) - shift], place[shift:] + 1, 0)
        columns.append(column)
    return Windows(names, words, columns, np.ones(len(starts), dtype=np.int64))


def _together(parts: pa.Table, longest: int) -> Windows:
    """The windows of several packed streams, merged."""
    packed = [[parts.column(n)[row].as_py() for n in ("langs", "words", "codes", "counts")] for row in range(parts.num_rows)]
    own = [json.loads(p[0]) for p in packed]
    names = sorted({name for langs in own for name in langs}, key=str.encode)
    number = {name: i for i, name in enumerate(names)}
    # Every stream's words, one after the other, and their places among all.
    words, place = _ranked(pa.concat_arrays([_split(_expand(p[1])) for p in packed]))
    counts = [np.frombuffer(_expand(p[3]), dtype=np.int64) for p in packed]
    columns = [np.empty(sum(map(len, counts)), dtype=np.int32) for _ in range(longest + 1)]
    row = word = 0
    for (_, mine, codes, _), langs, many in zip(packed, own, counts):
        codes = np.frombuffer(_expand(codes), dtype=np.int32).reshape(longest + 1, len(many))
        rows = slice(row, row + len(many))
        columns[0][rows] = np.array([number[v] for v in langs])[codes[0]]
        # A stream numbers its words from 1 without a gap.
        n_words = int(codes[1:].max())
        places = np.append(0, place[word : word + n_words] + 1).astype(np.int32)
        for column, code in zip(columns[1:], codes[1:]):
            column[rows] = places[code]
        row, word = rows.stop, word + n_words
    return Windows(names, words, columns, np.concatenate(counts))


def _split(data: bytes) -> pa.Array:
    """The words that blanks part."""
    letters = np.frombuffer(data, dtype=np.uint8)
    ends = np.append(np.flatnonzero(letters == 0x20), len(letters))
    offsets = np.append(0, ends - np.arange(len(ends))).astype(np.int64)
    kept = pa.py_buffer(letters[letters != 0x20].tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), kept])


PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])


def phrases_of(windows: Windows, least: int) -> pa.Table:
    """Frequent phrases of a range, its first and last ones, and all words of a language as the empty phrase."""
    langs, phrases, lengths, counts = [], [], [], []
    changed = np.zeros(len(windows), dtype=bool)
    changed[:1] = True
    for length, column in enumerate(windows.columns):
        # In order, a phrase's windows are those from one change of its words to the next.
        changed[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changed)
        sums = np.add.reduceat(windows.counts, starts) if len(starts) else np.empty(0, dtype=np.int64)
        wanted = (sums >= least) | (length == 0)
        wanted[:1] = wanted[-1:] = True
        if length:
            wanted &= column[starts] > 0
        chosen = starts[wanted]
        spelled = [windows.words.take(pa.array(c[chosen] - 1)).to_pylist() for c in windows.columns[1 : length + 1]]
        langs += [windows.langs[i] for i in windows.columns[0][chosen].tolist()]
        phrases += [b" ".join(w).decode() for w in zip(*spelled)] if length else [""] * len(chosen)
        lengths += [length] * len(chosen)
        counts += sums[wanted].tolist()
    return pa.table([langs, phrases, lengths, counts], schema=PHRASES)


def _bounds(docs: DataFrame, size: int, longest: int) -> list[tuple]:
    """Windows at which ranges of about equal size begin, the first range apart."""
    ranges = max(1, math.ceil(size / RANGE_BYTES))
    if ranges == 1:
        return []
    wanted = max(SAMPLE_BYTES, ranges * SAMPLE_A_RANGE)
    # A word and its blank take six bytes or so.
    step = max(1, wanted // 6 // (ranges * BOUNDS_FROM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, "text", BLOCK):
            found = windows_of(texts, rows.column(1).to_pylist(), longest)
            picked = [found[i] for i in range(step // 2, len(found), step)]
            yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in picked], pa.list_(pa.binary()))], names=["window"])

    sample = docs.sample(min(1.0, wanted / size), seed=11).mapInArrow(run, "window array<binary>")
    found = sorted(tuple(map(bytes, r.window)) for r in sample.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def count_phrases(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
) -> DataFrame:
    """(lang, phrase, words, n): phrases counted at least ``least`` times; the empty phrase counts all words."""
    docs = docs.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    bounds = docs.sparkSession.sparkContext.broadcast(_bounds(docs, size, longest))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, "text", BLOCK):
            found = windows_of(texts, rows.column(1).to_pylist(), longest)
            ends = [bisect_left(found, b) for b in bounds.value] + [len(found)]
            parts = [(i, a, b) for i, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
            if parts:
                packed = [{"part": i, **found.pack(a, b)} for i, a, b in parts]
                yield pa.RecordBatch.from_pylist(packed, schema=pa.schema(streams))

    streams = [("part", pa.int32()), ("langs", pa.string()), ("words", pa.binary()), ("codes", pa.binary()), ("counts", pa.binary())]
    parts = docs.mapInArrow(cut, "part int, langs string, words binary, codes binary, counts binary")
    found = parts.groupBy("part").applyInArrow(
        lambda table: phrases_of(_together(table, longest), least), "lang string, phrase string, words int, n long"
    )
    added = found.groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("n"))
    return added.where((F.col("n") >= least) | (F.col("words") == 0))


def _times(factor: int, count: Column) -> Column:
    return F.lit(factor).cast("decimal(18,0)") * count.cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST_COUNT,
    longer_percent: int = LONGER_PERCENT,
    most: int = MOST_PER_LANG,
) -> DataFrame:
    """Per language its best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    counts = count_phrases(docs, text_column=text_column, lang_column=lang_column, least=least)
    counts = written(counts, "phrases")
    totals = counts.where("words = 0").select("lang", "n")
    stream = counts.where("words > 0")
    phrases = stream.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    # The stream in prefix order gives what stands before a cut, in suffix order what stands after it.
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
    heads = stream.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = stream.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    cuts = cuts.join(heads.hint("merge"), ["lang", "head"]).join(tails.hint("merge"), ["lang", "tail"])
    score = F.floor(F.expr(f"(cast({SCORE_SCALE} as decimal(18,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # Counts of the extensions by one word to the right and to the left.
    longer = phrases.where("words > 2").select(
        "lang",
        F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"),
        "a",
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = lowest.join(longer.hint("merge"), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | (_times(100, F.col("longer")) < _times(longer_percent, F.col("a"))))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # A language may hold most phrases: they are ranked in groups first, each with at most as many as are wanted.
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    groups = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))).orderBy(*best)
    first = kept.withColumn("place", F.row_number().over(groups)).where(F.col("place") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= most)
    # One row a language.
    named = ranked.join(totals, "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
