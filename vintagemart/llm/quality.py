"""Quality rules: counts that decide by themselves, and a learned score.

The learned part is a logistic regression over hashed word and character n-grams
(words, word pairs, character triples and quadruples, each as a share of its
kind in the text), trained on labelled rows and calibrated on a part of them it
has not seen.  Tasks score texts in Arrow batches: hashes are computed on the
bytes of a whole block at once, and a text's score is the mean of the weights
its n-grams have.

Training takes at most ``SAMPLE_ROWS`` labelled rows and ``SAMPLE_TEXT`` bytes of their texts, the
first by a hash of the row, whatever the size of the corpus; counts and scores cover every row.

Defined results: a null or empty text, or one without words, has counts of 0 and
fails the base rules.  Labelled rows of both classes, however few, train the learned part; without
one of the classes there is nothing to tell apart and it keeps everything.  Ties, repeated rows and
extra columns do not matter, and an empty table gives no rows.  A very long text is a block by
itself, for which a task needs about a hundred times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .text import blocks, codes_of, window_codes

# Bounds of the training sample, tasks it is dealt over, and the part of it that only calibrates.
SAMPLE_ROWS = 4_000
SAMPLE_TEXT = 64 << 20
SAMPLE_TASKS = 16
CALIBRATION_SHARE = 0.25

# Texts are scored in blocks of about so many bytes; hashes take about a hundred times as much.
SCORE_BYTES = 512 << 10

# Training rows whose n-grams are laid out at once; the others stay as they came from the tasks.
ROW_BLOCK = 64

# Fixed threshold of the calibrated probability of being good; below it a text goes.
KEEP_FROM = 0.5

# Weights per kind of n-gram (a power of two) and the kinds: words, word pairs, 3 and 4 bytes.
SLOTS = 1 << 15
KINDS = 4
SCALE = 30.0

# Fixed values of the base rules.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

# Odd multipliers of the hashes.
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
UNMULTIPLY = np.uint64(pow(int(MULTIPLY), -1, 1 << 64))
FINISH = np.uint64(0xBF58476D1CE4E5B9)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, and words in repeated windows."""
    data = (text or "").encode()
    words = data.split()
    symbols = sum(map(data.count, SYMBOLS))
    if not words:
        return 0, 0, symbols, 0, 0
    chars = sum(map(len, words)) if text.isascii() else sum(len(w.decode()) for w in words)
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    repeated_lines = len(lines) - len(set(lines))
    return len(words), chars, symbols, repeated_lines, repeated_words(words)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words in windows of ``width`` words that the text has at least twice."""
    if len(words) <= width:
        return 0
    windows = window_codes(*codes_of(words), width)
    twice = np.bincount(windows)[windows] > 1
    if not twice.any():
        return 0
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def _slots(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(31))) * FINISH
    return (mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def hashed_kinds(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram, the text it stands in and its slot, over all texts at once."""
    encoded = [(t or "").encode() for t in texts]
    lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
    data = np.frombuffer(b" ".join(encoded) + b" ", dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    space = _IS_SPACE[data]
    # A word's hash is a difference of running sums, made independent of its place.
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
    powers = np.cumprod(np.full(len(data), MULTIPLY, dtype=np.uint64))
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers))
    back = np.cumprod(np.full(len(data), UNMULTIPLY, dtype=np.uint64))
    words = (sums[ends] - sums[starts]) * back[starts]
    whose = owner[starts]
    yield whose, _slots(words)
    if len(words) > 1:
        same = whose[1:] == whose[:-1]
        yield whose[1:][same], _slots(words[:-1][same] * MULTIPLY + words[1:][same])
    else:
        yield whose[:0], whose[:0]
    for width in (3, 4):
        if len(data) < width:
            yield whose[:0], whose[:0]
            continue
        gram = np.zeros(len(data) - width + 1, dtype=np.uint64)
        for i in range(width):
            gram = (gram << np.uint64(8)) | data[i : len(gram) + i]
        inside = owner[: len(gram)] == owner[width - 1 :]
        yield owner[: len(gram)][inside], _slots(gram[inside] * MULTIPLY + np.uint64(width))


def _means(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    """For each text the sum over kinds of the mean weight of its n-grams."""
    total = np.zeros(len(texts))
    for kind, (owner, slot) in enumerate(hashed_kinds(texts)):
        counts = np.bincount(owner, minlength=len(texts))
        sums = np.bincount(owner, weights=weights[kind][slot], minlength=len(texts))
        total += sums / np.maximum(counts, 1)
    return total


@dataclass(frozen=True)
class QualityModel:
    """Weights per kind and slot, and the line that turns a score into calibrated log odds."""

    weights: np.ndarray
    slope: float
    offset: float

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        return self.slope * _means(texts, self.weights) + self.offset

    def probability(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.log_odds(texts))


KEEP_ALL = QualityModel(np.zeros((KINDS, SLOTS)), 0.0, 30.0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts of ``SAMPLE_TEXT`` bytes in all, the first by a hash of the row."""
    wanted = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    order = F.xxhash64(F.col("doc_id").cast("string"))
    # Picked among the labels first, so that few texts are moved; a few more for ids without a text.
    picked = wanted.orderBy(order, "doc_id", "label").limit(2 * rows)
    joined = docs.select("doc_id", F.col("text")).join(F.broadcast(picked), "doc_id")
    first = (order, "doc_id", "label", F.xxhash64("text"))
    limited = joined.select("text", "label", "doc_id").orderBy(*first).limit(rows)
    # The window holds the sample and no more.  After a limit all rows are in one task; they are dealt out again.
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.partitionBy(F.lit(0)).orderBy(*first).rowsBetween(Window.unboundedPreceding, -1))
    bounded = limited.withColumn("_size", size).where(f"_size is null or _size < {SAMPLE_TEXT}")
    return bounded.select("text", "label").repartition(SAMPLE_TASKS)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's n-gram shares as (slot, share) lists; texts themselves stay in the task."""
    for rows, texts in blocks(batches, "text", SCORE_BYTES):
        parts = [[] for _ in texts]
        for kind, (owner, slot) in enumerate(hashed_kinds(texts)):
            key, count = np.unique(owner * SLOTS + slot, return_counts=True)
            sums = np.bincount(owner, minlength=len(texts))
            cut = np.searchsorted(key, np.arange(len(texts) + 1) * SLOTS)
            for i in range(len(texts)):
                k = key[cut[i] : cut[i + 1]]
                share = count[cut[i] : cut[i + 1]] * (SCALE / max(1, sums[i]))
                parts[i].append((((k - i * SLOTS) + kind * SLOTS).astype(np.int32), share.astype(np.float32)))
        slots = [b"".join(s.tobytes() for s, _ in p) for p in parts]
        shares = [b"".join(v.tobytes() for _, v in p) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots, pa.binary()), pa.array(shares, pa.binary()), rows.column(rows.schema.get_field_index("label"))],
            names=["slots", "shares", "label"],
        )


def fit(sample: DataFrame, *, steps: int = 120, ridge: float = 3e-4) -> QualityModel:
    """Train on a bounded sample of (text, label) rows and calibrate on the part left out.

    Where one of the two parts would lack a class, all rows stand in for that part.
    """
    # Task by task, so that the driver holds the lists once.
    rows = list(sample.mapInArrow(_sparse, "slots binary, shares binary, label int").toLocalIterator())
    # The lists are compared as they are, without a copy.
    rows.sort(key=lambda r: (r.label, r.slots, r.shares))
    y = np.array([r.label for r in rows], dtype=float)
    if len(set(y)) < 2:
        return KEEP_ALL
    held = np.arange(len(rows)) % round(1 / CALIBRATION_SHARE) == 0
    learned, calibrated = (part if len(set(y[part])) == 2 else np.full(len(y), True) for part in (~held, held))
    weights = _descend([r for r, h in zip(rows, learned) if h], y[learned], steps, ridge)
    score = np.zeros(int(calibrated.sum()))
    for here, row, column, value in _triples([r for r, h in zip(rows, calibrated) if h]):
        score[here] = np.bincount(row, weights=weights[column] * value, minlength=len(score[here])) / SCALE
    slope, offset = _platt(score, y[calibrated])
    return QualityModel(weights.reshape(KINDS, SLOTS), slope, offset)


def _triples(rows: list) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block, which rows it has, and row of the block, slot and share of their n-grams."""
    for start in range(0, len(rows), ROW_BLOCK):
        block = rows[start : start + ROW_BLOCK]
        slots = [np.frombuffer(r.slots, dtype=np.int32) for r in block]
        row = np.repeat(np.arange(len(block)), [len(s) for s in slots])
        shares = np.concatenate([np.frombuffer(r.shares, dtype=np.float32) for r in block])
        yield slice(start, start + len(block)), row, np.concatenate(slots), shares


def _descend(rows: list, y: np.ndarray, steps: int, ridge: float) -> np.ndarray:
    """Accelerated gradient descent of the ridge-penalised logistic loss, classes weighted alike."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    most = max((float(np.bincount(row, weights=value * value, minlength=1).max()) for _, row, _, value in _triples(rows)), default=0.0)
    bound = most * 0.25 + 0.25
    step = 1.0 / (bound + ridge)
    w = np.zeros(KINDS * SLOTS)
    ahead, bias, bias_ahead = w.copy(), 0.0, 0.0
    for k in range(steps):
        gradient, total = ridge * ahead, 0.0
        for here, row, column, value in _triples(rows):
            z = np.bincount(row, weights=ahead[column] * value, minlength=len(y[here])) + bias_ahead
            error = (_sigmoid(z) - y[here]) * share[here]
            gradient += np.bincount(column, weights=error[row] * value, minlength=len(w))
            total += error.sum()
        new, new_bias = ahead - step * gradient, bias_ahead - step * total
        pull = k / (k + 3)
        ahead, bias_ahead = new + pull * (new - w), new_bias + pull * (new_bias - bias)
        w, bias = new, new_bias
    return w * SCALE


def _platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the log odds by Newton steps, with softened targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    centre, spread = score.mean(), score.std() or 1.0
    x = np.column_stack([(score - centre) / spread, np.ones(len(y))])
    b = np.zeros(2)
    for _ in range(steps):
        p = _sigmoid(x @ b)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b - np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * b)
    return float(b[0] / spread), float(b[1] - b[0] * centre / spread)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(
    docs: DataFrame,
    model: QualityModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """Counts, base verdict, calibrated probability and final verdict of every text."""
    spark = docs.sparkSession
    # Bounded by KINDS * SLOTS weights.
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.slope, model.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = QualityModel(*shared.value)
        for rows, texts in blocks(batches, "text", SCORE_BYTES):
            counts = [base_counts(t) for t in texts]
            fails = [base_fails(c[0], c[4]) for c in counts]
            good = here.probability(texts)
            kept = [not f and bool(p >= keep_from) for f, p in zip(fails, good)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    *[pa.array(c, pa.int64()) for c in zip(*counts)],
                    pa.array(fails),
                    pa.array(good, pa.float64()),
                    pa.array(kept),
                ],
                names=[id_column, *COUNTS, "base_failed", "good_probability", "kept"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, " + "".join(f"{c} long, " for c in COUNTS) + "base_failed boolean, good_probability double, kept boolean"
    return docs.select(F.col(id_column), F.col(text_column).alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: QualityModel, *, text_column: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows that pass, columns as they are; a narrow job, no join.

    Only texts go to the Python workers and only verdicts come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.slope, model.offset))

    @F.arrow_udf("boolean")
    def passes(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        here = QualityModel(*shared.value)
        for column in columns:
            kept: list[bool] = []
            for _, texts in blocks(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text", SCORE_BYTES):
                good = here.probability(texts)
                kept += [not base_fails(c[0], c[4]) and bool(p >= keep_from) for c, p in zip(map(base_counts, texts), good)]
            yield pa.array(kept, pa.bool_())

    return docs.where(passes(F.col(text_column)))
