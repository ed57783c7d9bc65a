"""Token counts of whole texts by a two-tier lookup on the map side.

Tier one is a broadcast table of the lengths, in tokens, of the corpus's most
frequent pre-tokens, bounded by ``TABLE_SIZE`` entries.  It is made from one
summary of bounded size per task (Misra and Gries: every pre-token more frequent
than its share of the table is in it), and the summaries are merged in a tree;
no pre-token is shuffled.  Tier two is each worker's cache of what the table
misses, encoded by the library and bounded by ``CACHE_SIZE``.

A pre-token is a word with the blanks before it, or blanks at the end of a line; lines are
cut at their ends.  Cutting there is exact for a vocabulary whose pieces have blanks only at
their start and hold no line end, which is checked when the file is read.

Defined results: a null or empty text has no bytes and no tokens; rows are
treated one by one, so ties, repeated rows and extra columns do not matter.  An empty table gives no rows.  A
very long text is a block by itself; what stands between two blanks is encoded whole.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from ..sources.scratch import written
from .text import blocks

# Entries of the broadcast table and of each task's summary; entries of a worker's cache.
TABLE_SIZE = 20_000
CACHE_SIZE = 200_000

# Summaries merged by one task.
FAN_IN = 64

# How the vocabulary writes a blank, and the one line end.
BLANK = "▁"
LINE = "\n"

# What a first pre-token of a line after the first is stored under: it has no blank before it.
BARE = LINE

# A blank alone, and the parts of a line: words with the blanks before them, and blanks at the end.
LONE_BLANK = BARE + " "
PARTS = re.compile(" *[^ ]+| +")


class Pieces:
    """The vocabulary file as the library reads it, if its pieces let texts be cut."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) or LINE in p for p in pieces):
            raise ValueError(f"{path} has pieces that go across blanks or lines")
        if self.model.encode("a") == self.model.encode(" a") or self.model.encode("a b") == self.model.encode("a  b"):
            raise ValueError(f"{path} drops blanks")

    def lengths(self, keys: list[str]) -> list[int]:
        """Tokens of each pre-token; a key that begins with a line end has no blank before it."""
        counts = map(len, self.model.encode(keys, num_threads=1))
        # Before a line end stands the blank that every text begins with.
        return [n - 2 if k[0] == BARE else n for n, k in zip(counts, keys)]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, as the library has to be given them.

    It puts one blank before what it is given, so each has one of its own blanks less;
    one that begins a line, or is a single blank, stands behind a line end instead.
    """
    if BLANK in text:
        text = text.replace(BLANK, " ")
    first, *rest = text.split(LINE)
    plain = "  " not in text and " \n" not in text and "\n " not in text and text[-1:] != " " and text[:1] != " "
    if plain:
        out = first.split(" ") if first else []
        for line in rest:
            head, *tail = line.split(" ")
            out.append(BARE + head)
            out += tail
        return out
    out = PARTS.findall(first)
    out[1:] = [p[1:] or LONE_BLANK for p in out[1:]]
    for line in rest:
        parts = PARTS.findall(line)
        if parts and parts[0][0] != " ":
            out.append(BARE + parts.pop(0))
        out += [p[1:] or LONE_BLANK for p in parts]
    return out


class Counts:
    """Lengths a worker knows: the table, and a cache of bounded size."""

    def __init__(self, path: str, table: dict[str, int]):
        self.pieces, self.table, self.cache = pieces(path), table, {}

    def of(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; what neither tier knows is encoded once for all of them."""
        totals, rest = [], []
        for text in texts:
            words = pre_tokens(text) if text else []
            found = list(map(self.table.get, words))
            # Each line end is a token; so is the blank every text begins with if no word follows it.
            totals.append(sum(filter(None, found)) + (text.count(LINE) + text.startswith(LINE) if text else 0))
            rest.append([w for w, n in zip(words, found) if n is None] if None in found else [])
        self.learn({w for words in rest for w in words})
        return [n + sum(map(self.cache.__getitem__, words)) for n, words in zip(totals, rest)]

    def learn(self, words: set[str]) -> None:
        new = sorted(w for w in words if w not in self.cache)
        if not new:
            return
        if len(self.cache) + len(new) > CACHE_SIZE:
            self.cache = {w: self.cache[w] for w in words if w in self.cache}
        self.cache.update(zip(new, self.pieces.lengths(new)))


def _summary(batches: Iterator[pa.RecordBatch], size: int) -> Counter:
    seen: Counter = Counter()
    for _, texts in blocks(batches, "text"):
        for text in texts:
            if text:
                seen.update(pre_tokens(text))
        shrink(seen, 8 * size)
    shrink(seen, size)
    return seen


def shrink(seen: Counter, size: int) -> None:
    """Keep at most ``size`` entries, taking what the next one has off every count."""
    if len(seen) <= size:
        return
    kept = seen.most_common(size + 1)
    off = kept[-1][1]
    seen.clear()
    seen.update({w: n - off for w, n in kept[:-1] if n > off})


def frequent(docs: DataFrame, *, text_column: str = "text", size: int = TABLE_SIZE) -> list[str]:
    """The frequent pre-tokens of the whole corpus, at most ``size``."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": [part], "seen": [json.dumps(_summary(batches, size))]})

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("seen").to_pylist():
                seen.update(json.loads(text))
        shrink(seen, size)
        yield pa.RecordBatch.from_pydict({"part": [key[0].as_py()], "seen": [json.dumps(seen)]})

    schema = "part long, seen string"
    level = docs.select(F.col(text_column).alias("text")).mapInArrow(summarise, schema)
    tasks = written(level, "summaries")
    count = tasks.count()
    for _ in range(max(1, math.ceil(math.log(max(count, 2), FAN_IN)))):
        tasks = tasks.groupBy((F.col("part") / FAN_IN).cast("long").alias("group")).applyInArrow(_whole_group(merge), schema)
    last: Counter = Counter()
    for row in tasks.collect():
        last.update(json.loads(row.seen))
    return [w for w, _ in sorted(last.items(), key=lambda x: (-x[1], x[0]))[:size]]


def _whole_group(merge):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(merge(key, iter(table.to_batches())))

    return run


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """Bytes and tokens of every text, and whether it has more tokens than ``limit``."""
    spark = docs.sparkSession
    words = frequent(docs, text_column=text_column, size=table_size)
    table = spark.sparkContext.broadcast(dict(zip(words, pieces(path).lengths(words) if words else [])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, table.value)
        for rows, texts in blocks(batches, "text"):
            n = counts.of(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    text = F.col(text_column)
    return docs.select(
        F.col(id_column), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    ).mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
