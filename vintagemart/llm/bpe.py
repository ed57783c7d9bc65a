"""Byte-pair encoding and decoding of whole texts, by an index of pair occurrences.

The words that a task has not met yet are laid out as one long row of symbols.
An index maps every adjacent pair that has a merge to all its positions in that
row.  The ranks that occur are taken in ascending order, all positions of a pair
are merged at once, and the two pairs that each merge gives rise to enter the
lists of their own ranks.  A merge only ever makes pairs of a higher rank (checked
when the vocabulary is read), so this order gives every word the merges it would
get by itself.

Results are kept per white-space run in a cache of bounded size: encoding does not
look across white space, so equal runs have equal ids.

``encoded`` gives the ids of texts, ``decoded`` the texts of ids, and ``round_trips`` compares the
two by digests of their results.  All are narrow jobs.

Defined results: a null or empty text has no tokens; null or no ids decode to an empty text, and ids that the
vocabulary does not have are left out.  Rows are treated one by one, so ties and repeated rows do not
matter; columns of the names that are made are replaced.  An empty table gives no rows.  A very long text
is a block by itself.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Regex, Tokenizer, pre_tokenizers

from .text import blocks, give_back, hexdigest

# The layout of a vocabulary file that this encoder can read.
MODEL_TYPE = "BPE"
WORD_END = "</w>"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

# White-space runs a worker remembers before it starts over, and symbols merged at once.
CACHE_RUNS = 150_000
ROW_SYMBOLS = 4_000_000

# Lists of at most so many positions are merged one by one.
SHORT_LIST = 24

# Bytes of text whose new runs are learned together, and rows whose ids are decoded together.
LEARN_BYTES = 5 << 20
DECODE_ROWS = 500

# Fixed value: the first character after the Latin blocks, which no Unicode version changes.
SETTLED_END = "\u0250"

# Fixed value: the information separators, which are white space to str.split only.
SEPARATORS = regex.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PairIndexBpe:
    """A byte-level vocabulary with word ends, read from a ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (
            model["type"] != MODEL_TYPE
            or model["end_of_word_suffix"] != WORD_END
            or [s["type"] for s in steps] != NORMALIZERS
            or [s["type"] for s in splits] != ["Split", "ByteLevel"]
            or spec["decoder"] is not None
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path} is not laid out as this encoder expects")
        vocab: dict[str, int] = model["vocab"]
        self.pieces = {i: t for t, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces |= {i: t for t, i in self.specials.items()}
        self.size = max(self.pieces) + 1
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int32)
        self.final = np.array([vocab[letters[b] + WORD_END] for b in range(256)], dtype=np.int32)
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.split = pre_tokenizers.Split(Regex(self.pattern.pattern), "removed", invert=True)
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self._read_merges(vocab, model["merges"])

    def _read_merges(self, vocab: dict[str, int], merges: list) -> None:
        born: dict[int, int] = {}
        left, right, made = [], [], []
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if max(born.get(x, -1), born.get(y, -1)) >= rank:
                raise ValueError(f"merge {rank} comes before its parts")
            born[z] = max(born.get(z, -1), rank)
            left.append(x)
            right.append(y)
            made.append(z)
        keys = np.array(left, dtype=np.int64) * self.size + np.array(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.merge_of = list(zip(left, right, made))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, -1 for none."""
        keys = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (a >= 0) & (b >= 0), self.ranks[at], -1)

    def pre_tokens(self, text: str) -> list[str]:
        """The normalised pieces of a text that are encoded by themselves.

        Which characters are letters depends on the Unicode version, so texts beyond
        the Latin blocks go through the normalizer and the split the vocabulary came with.
        """
        if text.isascii():
            return self.pattern.findall(text.lower())
        if max(text) < SETTLED_END:
            return self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        return [piece for piece, _ in self.split.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each pre-token."""
        out: list[list[int]] = []
        block: list[bytes] = []
        size = 0
        for word in words:
            data = word.encode()
            if block and size + len(data) > ROW_SYMBOLS:
                out += self._merge_row(block)
                block, size = [], 0
            block.append(data)
            size += len(data)
        return out + self._merge_row(block) if block else out

    def _merge_row(self, words: list[bytes]) -> list[list[int]]:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(data)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        full = lengths > 0
        # The same memory as arrays of Python, for lists too short to be worth a numpy call.
        symbols = array("i", bytes(4 * (n + 1)))
        afters, befores = array("q", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
        symbol, after, before = (np.frombuffer(m, dtype=m.typecode) for m in (symbols, afters, befores))
        symbol[:n] = self.inner[data]
        symbol[ends[full] - 1] = self.final[data[ends[full] - 1]]
        symbol[n] = -1
        # Place n stands for "outside the word" on either side.
        after[:n] = np.arange(1, n + 1)
        after[n] = n
        after[ends[full] - 1] = n
        before[:n] = np.arange(-1, n - 1)
        before[n] = n
        before[starts[full]] = n

        lists: dict[int, list[int]] = {}
        heap: list[int] = []
        size, ranks_of = self.size, self.rank_of

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            known = ranks >= 0
            places, ranks = places[known], ranks[known]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order].tolist(), ranks[order]
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(ranks)) + 1), len(ranks)).tolist()
            for i, r in enumerate(ranks[cuts[:-1]].tolist()):
                if r in lists:
                    lists[r] += places[cuts[i] : cuts[i + 1]]
                else:
                    lists[r] = places[cuts[i] : cuts[i + 1]]
                    heapq.heappush(heap, r)

        enter(np.arange(n), self.rank(symbol[:n], symbol[after[:n]]))
        while heap:
            r = heapq.heappop(heap)
            places = lists.pop(r)
            a, b, made = self.merge_of[r]
            if len(places) <= SHORT_LIST:
                for place in sorted(places):
                    gone = afters[place]
                    if symbols[place] != a or symbols[gone] != b:
                        continue
                    follows = afters[gone]
                    symbols[place], symbols[gone] = made, -1
                    afters[place] = follows
                    previous = befores[place]
                    if follows != n:
                        befores[follows] = place
                        found = ranks_of.get(made * size + symbols[follows])
                        if found is not None:
                            if found in lists:
                                lists[found].append(place)
                            else:
                                lists[found] = [place]
                                heapq.heappush(heap, found)
                    if previous != n:
                        found = ranks_of.get(symbols[previous] * size + made)
                        if found is not None:
                            if found in lists:
                                lists[found].append(previous)
                            else:
                                lists[found] = [previous]
                                heapq.heappush(heap, found)
                continue
            at = np.sort(np.array(places))
            at = at[np.append(True, at[1:] != at[:-1])]
            at = at[(symbol[at] == a) & (symbol[after[at]] == b)]
            if a == b:
                at = _leftmost(at, after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = made
            symbol[gone] = -1
            follows = after[gone]
            after[at] = follows
            before[follows] = at
            before[n] = n
            previous = before[at]
            enter(previous, self.rank(symbol[previous], symbol[at]))
            enter(at, self.rank(symbol[at], symbol[follows]))
        kept = symbol[:n] >= 0
        counts = np.add.reduceat(np.append(kept, False), starts) if n else np.zeros(len(words), dtype=np.int64)
        counts = np.where(full, counts, 0)
        ids = symbol[:n][kept].tolist()
        out, at = [], 0
        for c in counts.tolist():
            out.append(ids[at : at + c])
            at += c
        return out

    def encode(self, text: str | None) -> list[int]:
        """The ids of one text."""
        ids: list[int] = []
        for part, special in self.parts(text):
            if special is not None:
                ids.append(special)
            else:
                for word in self.encode_words(self.pre_tokens(part)):
                    ids += word
        return ids

    def parts(self, text: str | None) -> Iterator[tuple[str, int | None]]:
        """The text between special strings, and the ids of those strings."""
        if not text:
            return
        at = 0
        if self.special is not None:
            for found in self.special.finditer(text):
                if found.start() > at:
                    yield text[at : found.start()], None
                yield found.group(), self.specials[found.group()]
                at = found.end()
        if at < len(text):
            yield text[at:], None

    def decode(self, ids: list[int]) -> str:
        """The pieces of the ids; without a decoder in the file, joined by a blank."""
        try:
            return " ".join(map(self.pieces.__getitem__, ids))
        except KeyError:
            return " ".join(self.pieces[i] for i in ids if i in self.pieces)


def _leftmost(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping pairs of one symbol, those that merging from the left takes."""
    taken: list[int] = []
    blocked = -1
    for place, follows in zip(places.tolist(), after[places].tolist()):
        if place != blocked:
            taken.append(place)
            blocked = follows
    return np.array(taken, dtype=np.int64)


class RunCache:
    """Ids of pre-tokens and of white-space runs, as bytes of 32-bit numbers, for one worker."""

    def __init__(self, bpe: PairIndexBpe, limit: int = CACHE_RUNS):
        self.bpe, self.limit = bpe, limit
        # What each id is spelled as and stands for, by its number.
        self.spelled = pa.array([str(i) for i in range(bpe.size)])
        self.pieces = pa.array([bpe.pieces.get(i) for i in range(bpe.size)], pa.string())
        self.words: dict[str, bytes] = {}
        self.of: dict[str, bytes] = {}

    def forget(self) -> None:
        self.words, self.of = {}, {}

    def learn(self, runs: set[str]) -> None:
        new = [r for r in runs if r not in self.of]
        if not new:
            return
        if len(self.of) + len(new) > self.limit:
            self.of = {r: self.of[r] for r in runs if r in self.of}
        split = [self.bpe.pre_tokens(r) for r in new]
        wanted = {w for ws in split for w in ws}
        if len(self.words) + len(wanted) > self.limit:
            self.words = {w: self.words[w] for w in wanted if w in self.words}
        words = [w for w in wanted if w not in self.words]
        known = self.words
        for word, ids in zip(words, self.bpe.encode_words(words)):
            known[word] = array("i", ids).tobytes()
        for run, ws in zip(new, split):
            self.of[run] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])

    def runs(self, text: str) -> list[tuple[list[str], int | None]]:
        out = []
        for part, special in self.bpe.parts(text):
            if special is not None:
                out.append(([], special))
            elif SEPARATORS.search(part):
                # These are not white space to the vocabulary: keep them inside a run.
                out.append((regex.split(r"[^\S\x1c-\x1f]+", part), None))
            else:
                out.append((part.split(), None))
        return out


@lru_cache(maxsize=2)
def _cache(path: str) -> RunCache:
    return RunCache(PairIndexBpe(path))


def _encode(batches: Iterator[pa.RecordBatch], path: str, ids_column: str) -> Iterator[pa.RecordBatch]:
    """The batches with ids in place of the texts, which are the last column."""
    cache = _cache(path)
    for rows, texts in blocks(batches, "_read", LEARN_BYTES):
        split = [cache.runs(t) if t else [] for t in texts]
        cache.learn({r for doc in split for runs, _ in doc for r in runs if r})
        of, found = cache.of, []
        for doc in split:
            parts: list[bytes] = []
            for runs, special in doc:
                if special is not None:
                    parts.append(array("i", [special]).tobytes())
                else:
                    parts += [of[r] for r in runs if r]
            found.append(b"".join(parts))
        ends = np.cumsum([0, *map(len, found)]) // 4
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), dtype=np.int32)))
        yield pa.RecordBatch.from_arrays([*rows.columns[:-1], ids], names=[*rows.schema.names[:-1], ids_column])
    # Workers outlive their tasks, and other stages need their memory.
    cache.forget()


def _joined(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """The names of each row's ids, joined by a blank; null where an id has none."""
    flat = ids.flatten()
    if len(flat) and (pc.min(flat).as_py() < 0 or pc.max(flat).as_py() >= len(names)):
        flat = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(names))), flat, pa.scalar(None, flat.type))
    ends = pa.array(ids.offsets.to_numpy() - ids.offsets[0].as_py(), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, names.take(flat)), " ")


def _decode(batches: Iterator[pa.RecordBatch], path: str, text_column: str, keep_ids: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches with texts in place of (or, to keep them, after) the ids, which are the last column."""
    cache = _cache(path)
    for batch in batches:
        for start in range(0, batch.num_rows, DECODE_ROWS):
            rows = batch.slice(start, DECODE_ROWS)
            ids = rows.columns[-1]
            texts = _joined(ids, cache.pieces)
            if texts.null_count:
                # Ids that the vocabulary does not have are left out.
                texts = pa.array([cache.bpe.decode(i) if t is None else t for i, t in zip(ids.to_pylist(), texts.to_pylist())], pa.string())
            kept = len(rows.columns) - (not keep_ids)
            yield pa.RecordBatch.from_arrays([*rows.columns[:kept], texts], names=[*rows.schema.names[:kept], text_column])


def _with_column(df: DataFrame, columns: list[str] | None, read: str, name: str, kind: DataType) -> tuple[DataFrame, StructType]:
    """The columns to carry along and the one to read, last; and the schema with the new column in its place."""
    kept = [c for c in (df.columns if columns is None else columns) if c != name]
    wanted = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{read}`").alias("_read"))
    return wanted, StructType([*wanted.schema.fields[:-1], StructField(name, kind, False)])


def encoded(docs: DataFrame, path: str, *, text_column: str = "text", ids_column: str = "token_ids", columns: list[str] | None = None) -> DataFrame:
    """The rows (or the named columns of them) with an array of ids."""
    wanted, schema = _with_column(docs, columns, text_column, ids_column, ArrayType(IntegerType(), False))
    return wanted.mapInArrow(lambda batches: _encode(batches, path, ids_column), schema)


def decoded(tokens: DataFrame, path: str, *, ids_column: str = "token_ids", text_column: str = "text", columns: list[str] | None = None) -> DataFrame:
    """The rows (or the named columns of them) with the text of their ids."""
    wanted, schema = _with_column(tokens, columns, ids_column, text_column, StringType())
    none = F.array().cast("array<int>")
    return wanted.withColumn("_read", F.coalesce("_read", none)).mapInArrow(lambda batches: _decode(batches, path, text_column), schema)


def round_trips(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every text encoded, and its ids decoded again: number of tokens, digests of ids and of the decoded text.

    One worker does both, so that neither ids nor decoded texts cross over to another
    one.  With ``keep_ids`` the ids themselves come last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _cache(path).spelled
        for rows in _decode(_encode(batches, path, "token_ids"), path, "decoded", keep_ids=True):
            id_, ids, texts = rows.columns
            digests = [pa.array(map(hexdigest, t.to_pylist()), pa.string()) for t in (_joined(ids, spelled), texts)]
            columns = [id_, pc.list_value_length(ids).cast(pa.int64()), *digests]
            yield pa.RecordBatch.from_arrays([*columns, *([ids] if keep_ids else [])], names=names)
            del rows, id_, ids, texts, digests, columns
            give_back()

    wanted, schema = _with_column(docs, [id_column], text_column, "token_ids", ArrayType(IntegerType(), False))
    found = [("n_tokens", LongType()), ("ids_sha256", StringType()), ("decoded_sha256", StringType())]
    schema = StructType([schema[0], *[StructField(n, kind, False) for n, kind in found], *(schema.fields[1:] if keep_ids else [])])
    names = schema.names
    return wanted.mapInArrow(run, schema)
