"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause.  One marks insults, more strongly where
the clause says of somebody that they are one.  One marks threats: a verb of harm, which counts whole once it
has somebody to be done to, or somebody who says they will find another.  One tells whether somebody is addressed, one whether a
negation stands before, one whether the clause reports what somebody else said.  Composed, they
are a single table of states, whose transitions have the outputs of the first two; every
match leaves its weight under the kind the state stands for (negated, reported, aimed at somebody), so
that a clause is judged, not an isolated word.  A text's score is a logistic
function of the weights gathered per kind.

The insults and their weights are learned: words, and beginnings of words, that
labelled toxic texts hold far more often than others.  So are the weights of the
kinds, pulled towards the values below.  Learning takes at most ``SAMPLE_ROWS``
labelled rows, the first by a hash of the row; every row is scored.

Defined results: a null or empty text, or one without a match, gets the score of
"nothing found".  Without labelled rows of both classes no insult is known.
Ties, repeated rows and extra columns do not matter; an empty table gives no rows.  A very long text is a
block by itself.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .text import blocks

# Bound of the learning sample, which also bounds the learned lexicon.
SAMPLE_ROWS = 12_000

# A term may enter the lexicon if so large a share of the toxic texts, and so many, hold it,
# and toxic texts hold it so many times as often as others (as a logarithm).
LEAST_SHARE, LEAST_TEXTS, LEAST_LOG_RATIO = 0.004, 3, 3.0

# A term enters if it explains so large a share of the toxic texts beyond what is already in;
# a clean text that holds it counts as so many toxic ones against it.  A whole word also
# enters by itself if so large a share of the toxic texts, and hardly another one, holds it.
LEAST_GAIN, CLEAN_COST = 0.003, 1.0
PLAIN_SHARE, PLAIN_LOG_RATIO = 0.05, 5.0

# Weight from which more of it says no more about a text, and the unit it is counted in.
ENOUGH, UNIT = 12.0, 4.0

# Near copies are texts of one label of whose min-hashes so many agree; they are looked for
# among texts that agree in a whole band.
HASHES, BAND, NEAR = 64, 4, 0.7

# Weight of a text without near copies; those of a group share one such weight (whole numbers,
# so that sums do not depend on their order).
WHOLE = 720_720

# Lengths of the beginnings of words that may become a pattern.
BEGINNINGS = (4, 5, 6, 7, 8)

# Fixed threshold of the score.
TOXIC_FROM = 0.3

# Words a worker remembers before it starts over.
CACHE_WORDS = 300_000

# Classes of words.
OTHER, INSULT, HARM, TARGET, NEGATION, REPORT, SPEAKER, INTENT, SEEK, COPULA, FILLER = range(11)
CLASSES = 11

# Words of each class in the languages of the corpus.
HARMS = "kill hurt destroy strangle töten umbringen vernichten tuer détruire matar destruir".split()
SEEKS = "find get hunt catch finden kriegen holen jagen trouver attraper encontrar buscar atrapar".split()
SPEAKERS = "i we ich wir je j nous yo nosotros".split()
INTENTS = "will shall gonna going ll werde werden vais allons voy vamos".split()
COPULAS = "are re is was bist seid ist es est êtes eres sois son".split()
FILLERS = "a an the such so really very just total totally ein eine einen so echt nur un une si vraiment una tan muy".split()
TARGETS = "you your yours yourself u he she they them du dich dir ihr euch sie tu te toi vous il elle ils tú te ti usted ustedes ellos".split()
NEGATIONS = "not never no neither nicht nie kein keine keinen ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote claimed called quoted sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó".split()
QUOTES = "\"“”«»„"
CLAUSE_ENDS = ".,;:!?\n"

# How far a negation reaches, in words.
NEGATION_REACH = 3

TOKEN = re.compile(rf"[^\W\d_]+|[{re.escape(CLAUSE_ENDS + QUOTES)}]")
LETTERS = re.compile(r"[^\W\d_]+")

# Kinds of match: insult or threat, times negated, reported, aimed at somebody.
THREAT = HARM
MATCHES = list(itertools.product((INSULT, THREAT), (0, 1), (0, 1), (0, 1)))

# How much more an insult counts that somebody is said to be, and what a threat counts: a verb of harm by
# itself, and with somebody it is aimed at.
SAID_TO_BE = 1.25
HARM_ALONE, HARM_AIMED = 1.0, 3.0

# What the learned weights of the kinds are pulled towards: a plain match counts 3,
# one that is negated or reported less, one aimed at somebody more.
PRIOR = 3 * np.array([(1.0 - 0.3 * n - 0.3 * r + 0.2 * t) for _, n, r, t in MATCHES])
PRIOR_OFFSET = -4.0


def _negation(state: int, kind: int) -> int:
    """Words for which a negation still holds."""
    return NEGATION_REACH if kind == NEGATION else max(0, state - 1)


def _report(state: int, kind: int) -> int:
    """Whether the clause reports speech: from a verb of saying on, or inside quotes."""
    return 1 if kind == REPORT else state


def _target(state: int, kind: int) -> int:
    """Whether somebody is addressed; holds for the whole clause."""
    return 1 if kind == TARGET else state


def _insult(state: int, kind: int) -> tuple[int, float]:
    """Where an insult would be said of somebody (1: after them, 2: after "are a", 3: one word further), and its factor."""
    if kind == INSULT:
        return 0, SAID_TO_BE if state else 1.0
    if kind == TARGET:
        return 1, 0.0
    if state and kind in (COPULA, FILLER):
        return 2, 0.0
    return (3 if state == 2 else 0), 0.0


def _threat(state: int, kind: int, target: int) -> tuple[int, float]:
    """How far a threat has come (1: a speaker, 2: who means to, 3: harm, 4: a search), and what it counts for now.

    Harm counts a little by itself and the rest once somebody was or is named; a search counts only if the
    speaker means it, and only with somebody named.
    """
    if kind == HARM:
        return (0, HARM_AIMED) if target else (3, HARM_ALONE)
    if kind == SEEK and state == 2:
        return (0, HARM_AIMED) if target else (4, 0.0)
    if kind == TARGET:
        return (state if state < 3 else 0), {3: HARM_AIMED - HARM_ALONE, 4: HARM_AIMED}.get(state, 0.0)
    if kind == SPEAKER:
        return max(state, 1), 0.0
    if kind == INTENT and state == 1:
        return 2, 0.0
    return state, 0.0


class State(NamedTuple):
    """One state of each transducer."""

    negation: int = 0
    report: int = 0
    target: int = 0
    insult: int = 0
    threat: int = 0

    def after(self, kind: int) -> tuple["State", float, float]:
        """The state after a word of a class, and the factors of an insult and of a threat that it completes."""
        insult, insulted = _insult(self.insult, kind)
        threat, threatened = _threat(self.threat, kind, self.target)
        return State(_negation(self.negation, kind), _report(self.report, kind), _target(self.target, kind), insult, threat), insulted, threatened


def compose() -> tuple[list[State], list[list[tuple[int, float, float]]]]:
    """The product of the transducers: the states that can be reached, and by state and class the next one and its outputs."""
    states, number, table = [State()], {State(): 0}, []
    while len(table) < len(states):
        row = []
        for kind in range(CLASSES):
            after, insulted, threatened = states[len(table)].after(kind)
            if after not in number:
                number[after] = len(states)
                states.append(after)
            row.append((number[after], insulted, threatened))
        table.append(row)
    return states, table


STATES, NEXT = compose()


@dataclass(frozen=True)
class Lexicon:
    """Weights of insults: whole words, and beginnings of words."""

    words: dict[str, float]
    beginnings: dict[str, float]

    def classify(self, word: str) -> tuple[int, float]:
        """Class and weight of a lower-cased word."""
        if word in self.words:
            return INSULT, self.words[word]
        for n in BEGINNINGS:
            if word[:n] in self.beginnings:
                return INSULT, self.beginnings[word[:n]]
        return _FIXED.get(word, (OTHER, 0.0))


_WORDS = {
    FILLER: FILLERS, COPULA: COPULAS, SEEK: SEEKS, INTENT: INTENTS, SPEAKER: SPEAKERS, HARM: HARMS,
    REPORT: REPORTS, NEGATION: NEGATIONS, TARGET: TARGETS,
}
# A word of several classes is of the last one.
_FIXED = {w: (kind, 1.0) for kind, words in _WORDS.items() for w in words}


class Matcher:
    """Finds clause matches; remembers which white-space words can matter at all."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.hit: dict[bytes, int] = {}

    def _hits(self, word: bytes) -> int:
        """What a word can be part of: 1 a match by itself, 2 and 4 a search and what it needs."""
        kinds = {self.lexicon.classify(w)[0] for w in LETTERS.findall(word.decode().lower())}
        found = (1 if kinds & {INSULT, HARM} else 0) | (2 if SEEK in kinds else 0) | (4 if INTENT in kinds else 0)
        if len(self.hit) >= CACHE_WORDS:
            self.hit.clear()
        self.hit[word] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        """Gathered weight per kind of match."""
        hit, seen = self.hit, 0
        for word in set(text.encode().split()) if text else ():
            found = hit.get(word)
            seen |= self._hits(word) if found is None else found
            if seen & 1 or seen >= 6:
                return self._scan(text)
        return np.zeros(len(MATCHES))

    def _scan(self, text: str) -> np.ndarray:
        out = np.zeros(len(MATCHES))
        state, quoted, open_matches = 0, 0, []

        def close() -> None:
            for kind, negated, reported, weight in open_matches:
                out[MATCHES.index((kind, negated, reported, STATES[state].target))] += weight
            open_matches.clear()

        for token in TOKEN.findall(text.lower()):
            if token in CLAUSE_ENDS:
                close()
                state = 0
                if token == "\n":
                    quoted = 0
            elif token in QUOTES:
                quoted = 1 - quoted
            else:
                kind, weight = self.lexicon.classify(token)
                after, insulted, threatened = NEXT[state][kind]
                if insulted or threatened:
                    negated, reported = int(STATES[state].negation > 0), STATES[state].report | quoted
                    if insulted:
                        open_matches.append((INSULT, negated, reported, insulted * weight))
                    if threatened:
                        open_matches.append((THREAT, negated, reported, threatened))
                state = after
        close()
        return np.minimum(out, ENOUGH) / UNIT


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    offset: float

    def score(self, features: np.ndarray) -> float:
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, float(features @ self.weights) + self.offset))))


def _spread() -> tuple[np.ndarray, np.ndarray]:
    """Fixed multipliers and offsets of the min-hashes."""
    rng = np.random.default_rng(5)
    return rng.integers(1 << 62, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(1 << 63, size=HASHES, dtype=np.uint64)


def _signature(words: list[str]) -> np.ndarray:
    """Min-hashes of a set of words; the share of them in which two sets agree estimates their similarity."""
    multiply, add = _spread()
    least = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint64)
    for at in range(0, len(words), 4096):
        digests = b"".join(blake2b(w.encode(), digest_size=8).digest() for w in words[at : at + 4096])
        hashes = np.frombuffer(digests, dtype="<u8")[:, None]
        least = np.minimum(least, ((hashes * multiply + add) >> np.uint64(32)).min(axis=0))
    return least.astype("<u4")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words and beginnings of each text, their digest, and min-hashes of the words."""
    for rows, texts in blocks(batches, "text"):
        terms, keys, signatures = [], [], []
        for text in texts:
            words = sorted({w for w in LETTERS.findall((text or "").lower()) if len(w) >= BEGINNINGS[0]})
            terms.append(sorted({*words, *(w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n)}))
            # Words determine the terms.
            keys.append(blake2b(" ".join(words).encode(), digest_size=16).hexdigest())
            signatures.append(_signature(words).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.list_(pa.string())),
                pa.array(keys),
                pa.array(signatures, pa.binary()),
                rows.column(rows.schema.get_field_index("label")),
            ],
            names=["terms", "key", "signature", "label"],
        )


def group_sizes(signatures: np.ndarray) -> np.ndarray:
    """For each row of min-hashes, how many rows its group of near copies has.

    Rows that agree in a band are candidates; those near enough to the first of them
    are linked to it, the others are compared with the first that is left, and so on.
    """
    n = len(signatures)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, HASHES, BAND):
        _, band = np.unique(signatures[:, at : at + BAND], axis=0, return_inverse=True)
        order = np.argsort(band.ravel(), kind="stable")
        for left in np.split(order, np.flatnonzero(np.diff(band.ravel()[order])) + 1):
            while len(left) > 1:
                near = (signatures[left] == signatures[left[0]]).mean(axis=1) >= NEAR
                for i in left[near][1:].tolist():
                    a, b = sorted((find(left[0]), find(i)))
                    root[b] = a
                left = left[~near]
    _, group, size = np.unique([find(i) for i in range(n)], return_inverse=True, return_counts=True)
    return size[group]


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms of toxic texts from a bounded sample of (text, label); a group of near copies counts once.

    Texts with the same words are one; every other text counts with all its terms,
    near copies with one over the size of their group.  Of the terms that toxic texts
    hold far more often, only those enter that explain texts the others do not: the
    words of a few copied texts explain little.
    """
    texts = sample.mapInArrow(_terms, "terms array<string>, key string, signature binary, label int")
    once = texts.groupBy("key", "label").agg(F.min("terms").alias("terms"), F.min("signature").alias("signature")).persist()
    weights: list[tuple[str, int, int]] = []
    totals: Counter = Counter()
    marks = once.select("key", "label", "signature").collect()
    for label in (0, 1):
        rows = sorted((r.key, bytes(r.signature)) for r in marks if r.label == label)
        if rows:
            sizes = group_sizes(np.array([np.frombuffer(s, dtype="<u4") for _, s in rows]))
            weights += [(key, label, WHOLE // int(size)) for (key, _), size in zip(rows, sizes)]
        totals[label] = sum(w for _, l, w in weights if l == label) / WHOLE
    toxic, clean = totals[1], totals[0]
    if not toxic or not clean:
        once.unpersist()
        return Lexicon({}, {})
    # At most as many rows as the sample has.
    weighed = F.broadcast(sample.sparkSession.createDataFrame(weights, "key string, label int, share long"))
    once_weighed = once.select("key", "label", "terms").join(weighed, ["key", "label"])
    counts = once_weighed.select("label", "share", F.explode("terms").alias("term")).groupBy("term").agg(
        *[(F.sum(F.when(F.col("label") == label, F.col("share")).otherwise(0)) / WHOLE).alias(name) for label, name in ((1, "a"), (0, "b"))]
    )
    ratio = F.log(((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1)))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic)
    found = (
        counts.where(F.col("a") >= least)
        .select("term", "a", ratio.alias("weight"))
        .where(F.col("weight") >= min(LEAST_LOG_RATIO, 0.7 * math.log(2.0 * (clean + 1))))
        .orderBy(F.desc("a"), "term")
        .collect()
    )
    # Each of these is in a share of the sample's toxic texts, so there are at most some terms of a text over that share.
    weight = {r.term: float(r.weight) for r in found}
    known = F.broadcast(sample.sparkSession.createDataFrame([(t,) for t in sorted(weight)], "term string"))
    # Which of these terms each text of the sample holds.
    held = once_weighed.select("key", "label", "share", F.explode("terms").alias("term")).join(known, "term")
    held = held.groupBy("key", "label", "share").agg(F.collect_set("term").alias("held"))
    texts_of: dict[str, set[int]] = {t: set() for t in weight}
    shares: dict[int, int] = {}
    clean_of: Counter = Counter()
    for i, r in enumerate(held.collect()):
        shares[i] = r.share
        for term in r.held:
            if r.label:
                texts_of[term].add(i)
            else:
                clean_of[term] += r.share
    once.unpersist()
    chosen = _cover(texts_of, clean_of, max(1, LEAST_GAIN * toxic) * WHOLE, shares)
    chosen += [r.term for r in found if r.a >= PLAIN_SHARE * toxic and r.weight >= PLAIN_LOG_RATIO and not r.term.endswith("*")]
    return Lexicon(
        {t: weight[t] for t in chosen if not t.endswith("*")}, {t[:-1]: weight[t] for t in chosen if t.endswith("*")}
    )


def _cover(texts_of: dict[str, set[int]], clean_of: Counter, least: float, shares: dict[int, int]) -> list[str]:
    """Terms that together explain the toxic texts, each by what it adds to those before it."""
    chosen, left = [], {t: set(texts) for t, texts in texts_of.items()}
    gains = {t: sum(shares[i] for i in texts) - CLEAN_COST * clean_of[t] for t, texts in left.items()}
    while left:
        # Of equal gains the one that is not a beginning, then the shorter one.
        term = max(left, key=lambda t: (gains[t], not t.endswith("*"), -len(t), t))
        if gains[term] < least:
            break
        chosen.append(term)
        texts = left.pop(term)
        for other, its in left.items():
            both = its & texts
            gains[other] -= sum(shares[i] for i in both)
            its -= both
    return chosen


def fit(sample: DataFrame, *, steps: int = 60, ridge: float = 0.02) -> ToxicityModel:
    """Lexicon, then weights of the kinds of match by Newton steps towards the prior."""
    lexicon = learn_lexicon(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for rows, texts in blocks(batches, "text"):
            features = [matcher.features(t).tolist() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.list_(pa.float64())), rows.column(rows.schema.get_field_index("label"))],
                names=["features", "label"],
            )

    rows = sample.mapInArrow(run, "features array<double>, label int").collect()
    prior = np.append(PRIOR, PRIOR_OFFSET)
    if not rows:
        return ToxicityModel(lexicon, PRIOR, PRIOR_OFFSET)
    rows.sort(key=lambda r: (r.label, r.features))
    x = np.column_stack([np.array([r.features for r in rows]), np.ones(len(rows))])
    y = np.array([r.label for r in rows], dtype=float)
    b = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        gradient = x.T @ (p - y) / len(y) + ridge * (b - prior) / 10
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge / 10 * np.eye(len(b))
        move = np.linalg.solve(hessian, gradient)
        b = b - move * min(1.0, 2.0 / (np.abs(move).max() + 1e-12))
    return ToxicityModel(lexicon, b[:-1], float(b[-1]))


def held_out(id_column: str = "doc_id") -> Column:
    """The rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    toxic_from: float = TOXIC_FROM,
) -> DataFrame:
    """Score and prediction of every text."""
    # Bounded by the lexicon's size.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = shared.value
        matcher = Matcher(here.lexicon)
        for rows, texts in blocks(batches, "text"):
            scores = [here.score(matcher.features(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(scores), pa.array([int(s >= toxic_from) for s in scores], pa.int32())],
                names=[id_column, "held_out", "score", "predicted"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("text"), held_out(id_column).alias("held_out")).mapInArrow(
        run, f"`{id_column}` {kind}, held_out boolean, score double, predicted int"
    )
