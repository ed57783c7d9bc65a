"""Secret scan: patterns, and runs of characters that look random.

The patterns find assignments of credentials, access keys and long hexadecimal
numbers.  Beyond them, every long run of key characters is judged by two
character Markov models, one of random strings and one of ordinary words: it is
a secret if the log-likelihood ratio of the two is high.  Both models are counted
over all documents, in which the patterns label the random strings, and all other
words too short to be judged are ordinary; long runs that no pattern matches may be either and count for
neither.  Equal words are counted first, in the tasks that read them, and only distinct ones are taken apart.

All of it is SQL on columns: the pattern engine gives the matches and the text
between them, whose lengths add up to positions in code points.  The scan has no
shuffle, and rows without a match pass with a few pattern tests.

Defined results: a null or empty text has no spans.  If the documents hold no
random strings, only the patterns count.  Ties, repeated rows and extra columns
do not matter; an empty table gives no rows.  A very long text is one row of one task, as it is elsewhere in SQL.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

# A run is a secret from this mean log-likelihood ratio per character on (natural logarithm).
LEAST_MEAN_RATIO = 0.7

# The patterns, and the least length of what counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
ASSIGN_HINT = r"(?i)passw|secret|token|api_?key"

# Kinds in the order in which spans at one place are listed.
ASSIGN_KIND, ACCESS_KIND, HEX_KIND, RANDOM_KIND = range(4)
KIND_NAMES = ["assign", "access", "hex", "random"]

# Characters of a run that may be random, and the least length of such a run.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN_LEAST = 20
RUN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{RUN_LEAST},}}"
ORDINARY_LEAST = 6
ORDINARY = rf"[A-Za-z0-9+/_=-]{{{ORDINARY_LEAST},}}"

SPAN = "struct<start:int,kind:int,end:int>"


def _located(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places: array of (start, end, match)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("found"), F.slice(between, 1, F.size(found)).alias("before"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

    def add(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["before"])
        end = begin + F.length(pair["found"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["found"].alias("match"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pairs, start, add, lambda done: done["spans"])


def _spans(text: Column, hint: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of one kind; the pattern engine only locates them in texts that pass the hint."""
    found = _located(text, pattern)
    if keep is not None:
        found = F.filter(found, keep)
    spans = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    return F.when(hint, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _long_value(span: Column) -> Column:
    return F.length(F.regexp_extract(span["match"], ASSIGN, 2)) >= ASSIGN_LEAST


def pattern_spans(text: Column) -> dict[str, Column]:
    """The spans of each pattern."""
    return {
        "assign": _spans(text, text.rlike(ASSIGN_HINT), ASSIGN, ASSIGN_KIND, _long_value),
        "access": _spans(text, text.contains("AKIA"), ACCESS, ACCESS_KIND),
        "hex": _spans(text, text.rlike(HEX), HEX, HEX_KIND),
    }


def _places(run: Column) -> Column:
    """The number of each character in the alphabet, from 1; 0 for others."""
    return F.transform(F.split(run, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring characters in (random, string) rows; a blank stands before the first."""
    counted = strings.groupBy("random", "string").agg(F.count(F.lit(1)).alias("n"))
    codes = counted.select("random", "n", F.split("string", "").alias("c"))
    both = F.arrays_zip(F.concat(F.array(F.lit(" ")), F.col("c")).alias("a"), F.col("c").alias("b"))
    pairs = codes.select("random", "n", F.explode(both).alias("p")).where("p.b is not null")
    return pairs.groupBy("random", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("n").alias("count"))


class RandomModel:
    """Log-likelihood ratios by (previous character, character), as one flat list."""

    def __init__(self, ratios: list[float]):
        self.ratios = ratios

    def mean_ratio(self, run: Column) -> Column:
        # A text that folds to one array literal, looked up by position.
        table = F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")
        width = len(ALPHABET) + 1
        start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

        def add(done: Column, code: Column) -> Column:
            ratio = F.get(table, done["last"] * width + code)
            return F.struct(code.alias("last"), (done["sum"] + F.coalesce(ratio, F.lit(0.0))).alias("sum"))

        return F.aggregate(_places(run), start, add, lambda done: done["sum"]) / F.length(run)


def learn(docs: DataFrame, *, text_column: str = "text") -> RandomModel | None:
    """Models of random and ordinary strings from all documents."""
    texts = docs.select(F.col(text_column).alias("text"))
    text = F.col("text")
    none = F.array().cast("array<string>")
    values = F.when(text.rlike(ASSIGN_HINT), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    values = F.filter(F.coalesce(values, none), lambda v: F.length(v) >= ASSIGN_LEAST)
    others = F.concat(F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(text, F.lit(HEX), F.lit(0)))
    # What the patterns match is taken out, where a text may have any of it.
    bare = F.when(text.rlike(ASSIGN_HINT), F.regexp_replace(text, ASSIGN, " ")).otherwise(text)
    bare = F.when(bare.contains("AKIA"), F.regexp_replace(bare, ACCESS, " ")).otherwise(bare)
    bare = F.when(bare.rlike(HEX), F.regexp_replace(bare, HEX, " ")).otherwise(bare)
    words = F.filter(F.regexp_extract_all(bare, F.lit(ORDINARY), F.lit(0)), lambda w: F.length(w) < RUN_LEAST)
    kinds = F.array(
        F.struct(F.lit(True).alias("random"), F.concat(values, others).alias("strings")),
        F.struct(F.lit(False).alias("random"), words.alias("strings")),
    )
    found = texts.where("text is not null").select(F.explode(kinds).alias("k"))
    # At most two rows for each pair of characters that a string can have.
    counts = _pairs(found.select("k.random", F.explode("k.strings").alias("string"))).collect()
    random, ordinary = ([(_code(r.a), _code(r.b), r["count"]) for r in counts if r.random == kind] for kind in (True, False))
    return RandomModel(_ratios(random, ordinary)) if random else None


def _code(character: str) -> int:
    return ALPHABET.find(character) + 1


def _ratios(random: list, ordinary: list) -> list[float]:
    """Of the two models' transition probabilities, each count raised by one."""
    width = len(ALPHABET) + 1
    tables = []
    for rows in (random, ordinary):
        counts, totals = defaultdict(int), defaultdict(int)
        for a, b, n in rows:
            counts[a, b] += n
            totals[a] += n
        tables.append([math.log((counts[a, b] + 1) / (totals[a] + width)) for a in range(width) for b in range(width)])
    return [r - o for r, o in zip(*tables)]


def _apart(span: Column, others: Column) -> Column:
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def with_spans(docs: DataFrame, model: RandomModel | None, *, text_column: str = "text", least_ratio: float = LEAST_MEAN_RATIO) -> DataFrame:
    """The rows with ``_base`` and ``_spans``: sorted arrays of (start, kind, end)."""
    text = F.col(text_column)
    found = docs.withColumns({f"_{k}": F.coalesce(v, F.array().cast(f"array<{SPAN}>")) for k, v in pattern_spans(text).items()})
    found = found.withColumn("_base", F.sort_array(F.concat("_assign", "_access", "_hex")))
    if model is None:
        return found.withColumn("_spans", F.col("_base"))
    added = _spans(text, text.rlike(RUN), RUN, RANDOM_KIND, lambda s: model.mean_ratio(s["match"]) >= least_ratio)
    added = F.coalesce(F.filter(added, lambda s: _apart(s, F.col("_base"))), F.array().cast(f"array<{SPAN}>"))
    return found.withColumn("_spans", F.sort_array(F.concat("_base", added)))


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KIND_NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, model: RandomModel | None, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts per pattern, a digest of their spans, and all spans of every document."""
    found = with_spans(docs.select(F.col(id_column), F.col(text_column).alias("text")), model)
    return found.select(
        id_column,
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, model: RandomModel | None, *, text_column: str = "text", mark: str = "<secret>") -> DataFrame:
    """The rows with every secret replaced by a mark; overlapping spans give one mark."""
    # The row stays packed, so that none of its columns can meet one that is made here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_column).alias("text"))
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, span: Column) -> Column:
        apart = span["start"] >= done["at"]
        piece = F.array(text.substr(done["at"] + 1, span["start"] - done["at"]), F.lit(mark))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(done["parts"], piece)).otherwise(done["parts"]).alias("parts"),
        )

    whole = F.aggregate(
        F.col("_spans"), start, add, lambda done: F.concat(F.array_join(done["parts"], ""), text.substr(done["at"] + 1, F.length(text)))
    )
    found = with_spans(packed, model)
    clean = F.when(F.size("_spans") > 0, whole).otherwise(text)
    return found.select(F.col("row").withField(f"`{text_column}`", clean).alias("row")).select("row.*")
