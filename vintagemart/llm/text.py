"""Small helpers for texts inside tasks, shared by the operators.

Words are the maximal runs of characters other than blank and the five control
characters from tab to carriage return; all of these are single bytes in UTF-8,
so splitting the encoded text gives the words' bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the characters of a word, as a pattern for SQL.
WORD = r"[^\x20\x09-\x0D]+"

# Documents are taken in blocks of about this many bytes of text, so that what a
# task holds at once does not depend on how long documents are (one long document
# is a block by itself).
BLOCK_BYTES = 4 << 20


def words_of(text: str | None) -> list[bytes]:
    """The words of one text as UTF-8; none for a null."""
    return text.encode().split() if text else []


def hexdigest(data: str | bytes) -> str:
    return sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower_ascii(data: bytes) -> bytes:
    """A to Z lower-cased, every other byte as it is."""
    return data.lower()


def blocks(batches: Iterator[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with their texts, each of about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(_lengths(column))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start), column.slice(start, stop - start).to_pylist()
            base, start = int(ends[stop - 1]), stop


def give_back() -> None:
    """Give freed memory back to the system: a worker lives on after its task, beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def codes_of(words: list[bytes]) -> tuple[np.ndarray, int]:
    """A number for each word, equal for equal words, and how many numbers there are."""
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    codes = np.fromiter((put(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    return codes, len(seen)


def window_codes(codes: np.ndarray, distinct: int, width: int) -> np.ndarray:
    """A number for each window of ``width`` codes, equal exactly for equal windows.

    Windows are built by doubling: a window of 2k is a pair of windows of k, and
    pairs are numbered anew, so that no hash decides.
    """
    if len(codes) < width:
        return np.empty(0, dtype=np.int64)
    out, have, size, done = None, codes, distinct, 0
    span, left = 1, width
    while left:
        if left & 1:
            piece = have[done : done + len(codes) - width + 1]
            if out is None:
                out, total = piece, size
            else:
                out, total = renumber(out * size + piece)
            done += span
        left >>= 1
        if left:
            have, size = renumber(have[:-span] * size + have[span:])
            span *= 2
    return out


def renumber(values: np.ndarray) -> tuple[np.ndarray, int]:
    codes, uniques = pd.factorize(values)
    return codes.astype(np.int64), max(1, len(uniques))
