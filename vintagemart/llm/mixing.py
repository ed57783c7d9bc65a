"""Mixing sources to target weights by Pareto order sampling of whole documents.

Every source gets a target in words: its weight's part of the mix, but at most a
fixed multiple of its size, the excess going to the others by weight.  Of a
source's documents all are taken as often as fits into the target whole (certain
copies).  What is left is drawn with unequal chances.  A document's chance grows
with the square root of its words (and with a weight column, if one is given), and chances are
scaled so that the words expected are the words left.  Documents whose chance would be one or
more are certain too, and the chances of the others are scaled anew until there
are none.  The others are ranked by the odds of a random number divided by the odds of their own
chance, and taken in that order until the words left are reached, to within half of the document
on the boundary.  The sample's size is fixed in words.

The random number comes from a digest of the document's id, its size and its number among
rows of the same id, source and size, so reruns agree, and such rows do not share one.

No source is ever brought into one task: ranks are cut into buckets, sizes are
added up per source and bucket before they are shuffled, and running sums are
taken over buckets.  Which chances are certain is found on one row per source and chance.  A
source of which only whole copies are taken has no boundary
and is left out of that.  Only the bucket on the boundary is looked into, again by
buckets, and at last the few documents of one bucket of a bucket are put in
order.  Sums over sources run over one row per source.  Rows of the same id, source and size are numbered
task by task, and tasks by their counts.

Defined results: a null text or one without words has size 0 and is never
counted; null sources are one source, the last one.  Repeated rows are documents of their own.  A null
weight counts as 1, one below the least as the least.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import written
from .text import WORD

# Fixed values of the mix: weights of the sources in their order, repeating; words of
# the whole mix as a multiple of all words; the most a source may be repeated.
WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5
MOST_REPEATS = 2

# Fixed value: chances are whole multiples of a sixteenth of a square root, so that their sums are exact.
CHANCE_STEPS = 16

# Buckets of ranks per level; two levels are looked into.
BUCKETS = 4096

# Hexadecimal digits of the digest that make the random number.
RANDOM_DIGITS = 12


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: str = "mix") -> Column:
    """A number between 0 and 1 from what tells a row from others, never either of them."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *texts).cast("binary"))
    whole = F.conv(F.substring(digest, 1, RANDOM_DIGITS), 16, 10).cast("double")
    return (whole + 0.5) / float(16**RANDOM_DIGITS)


KEY = ("id", "source", "size")


def _same(left: DataFrame, right: DataFrame, how: str, names=KEY) -> DataFrame:
    """A join on columns that may be null; the right side's copies of them go."""
    renamed = right.select(*[F.col(c).alias(f"_{c}" if c in names else c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names])
    return left.join(renamed, on, how).drop(*[f"_{c}" for c in names])


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with their number among those of the same id, source and size, from 0."""
    repeated = written(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*KEY), "mix-repeated")
    if not repeated.limit(1).count():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    # Written, so that every later read sees the same place on a row; the high bits are the task's.
    again = _same(rows, repeated, "left_semi").withColumn("place", F.monotonically_increasing_id())
    again = written(again.withColumn("task", F.shiftright("place", 33)), "mix-again")
    counts = again.groupBy(*KEY, "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*KEY).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*KEY, "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy(*KEY, "task").orderBy("place"))
    numbered = _same(again.withColumn("local", local), counts, "inner", (*KEY, "task"))
    numbered = numbered.withColumn("copy", (F.col("before") + F.col("local") - 1).cast("long"))
    others = _same(rows, repeated, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return others.unionByName(numbered.select(*others.columns))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = MIX_SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: size, target, certain copies, and words left.

    Sources whose part is above their cap are those with the smallest caps for
    their weight, so one pass in that order finds how the rest share.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.select("source", "source_size", F.get(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight"))
    cap = float(most) * F.col("source_size")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.try_divide(
        F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    )
    levels = weighed.withColumn("cap", cap).withColumn("level", level)
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    shared = levels.withColumn("shared", F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("cap") / F.col("weight"))).over(every))
    target = F.coalesce(F.least("cap", F.col("shared") * F.col("weight")), F.lit(0.0))
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    return (
        shared.select("source", "source_size", target.alias("target"))
        .select("source", "source_size", "target", F.floor(ratio).cast("long").alias("copies"))
        .select("*", (F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"))
    )


def chances(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source with words left: the chance above which documents are certain, and what is left for the others.

    Below ``sure``, a document's chance is ``rest * chance / scale``.
    """
    # One row per source and chance; its sums are whole numbers.
    by_chance = sized.groupBy("source", "chance").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("chance")).alias("moment"))
    joined = _same(by_chance, wanted.where("rest > 0"), "inner", ("source",))
    falling = Window.partitionBy("source").orderBy(F.desc("chance"))
    above = F.coalesce(F.sum("words").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    scale = F.sum("moment").over(falling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    steps = joined.withColumn("rest", F.col("rest") - above).withColumn("scale", scale.cast("double"))
    # The first, from above, whose chance is below one.
    below = steps.where(F.col("rest") * F.col("chance") < F.col("scale"))
    first = F.max_by(F.struct(F.col("chance").alias("sure"), "rest", "scale"), "chance").alias("first")
    return below.groupBy("source").agg(first).select("source", "first.*")


def _ranked(rows: DataFrame, left: DataFrame, how: str = "inner") -> DataFrame:
    """The rows with their source's figures and their rank, as one number and as two buckets; certain ones have none."""
    joined = _same(rows, left, how, ("source",))
    share = F.col("rest") * F.col("chance") / F.col("scale")
    odds = F.col("u") / (1 - F.col("u"))
    pareto = F.try_divide(odds, share / (1 - share))
    # Any growing function of the rank serves; this one lies between 0 and 1.
    rank = F.when(F.col("chance") <= F.col("sure"), F.coalesce(pareto / (1 + pareto), F.lit(1.0)))
    scaled = F.col("rank") * BUCKETS
    return (
        joined.withColumn("rank", rank)
        .withColumn("coarse", F.floor(scaled).cast("int"))
        .withColumn("fine", F.floor((scaled - F.col("coarse")) * BUCKETS).cast("int"))
    )


def _boundary(sums: DataFrame, bucket: str, start: Column) -> DataFrame:
    """Per source, the first bucket whose running sum passes the words left, and the sum before it."""
    order = Window.partitionBy("source").orderBy(bucket)
    running = sums.withColumn("after", start + F.sum("words").over(order))
    passed = running.where(F.col("after") > F.col("rest"))
    return passed.groupBy("source").agg(F.min_by(F.struct(bucket, (F.col("after") - F.col("words")).alias("before")), bucket).alias("cut"))


def taken(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight_column: str | None = None,
    keep_row: bool = False,
    seed: str = "mix",
) -> DataFrame:
    """How many copies the mix takes of every document (and the row itself, if asked for).

    ``weight_column`` makes documents of a source more or less likely than others.
    """
    weight = F.coalesce(F.col(weight_column).cast("double"), F.lit(1.0)) if weight_column else F.lit(1.0)
    plain = [
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        size_of(F.col(text_column)).alias("size"),
        weight.alias("weight"),
    ]

    def drawn(rows: DataFrame) -> DataFrame:
        chance = F.greatest(F.lit(1), F.floor(CHANCE_STEPS * F.sqrt(F.col("size").cast("double")) * F.col("weight"))).cast("long")
        rows = _numbered(rows).withColumn("chance", F.when(F.col("size") > 0, chance).otherwise(F.lit(0)).cast("long"))
        return rows.withColumn("u", uniform(F.col("id"), F.col("size"), F.col("copy"), seed=seed)).drop("weight", "copy")

    # Sizes are needed several times and the texts only once.
    sized = written(drawn(written(docs.select(*plain), "mix-words")), "mix-sizes")
    wanted = written(targets(sized), "mix-targets")
    left = written(chances(sized, wanted), "mix-chances")
    # Nothing is left to draw beyond whole copies where the rest is zero; those rows are never put in order.
    ranked = _ranked(sized, left).where("rank is not null")
    coarse = _boundary(
        ranked.groupBy("source", "coarse").agg(F.sum("size").alias("words"), F.first("rest").alias("rest")), "coarse", F.lit(0)
    ).select("source", F.col("cut.coarse").alias("cut_coarse"), F.col("cut.before").alias("before"))
    inside = _same(ranked, coarse, "inner", ("source",)).where("coarse = cut_coarse")
    fine = _boundary(
        inside.groupBy("source", "fine").agg(
            F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before"), F.first("cut_coarse").alias("cut_coarse")
        ),
        "fine",
        F.col("before"),
    ).select("source", F.col("cut.fine").alias("cut_fine"), F.col("cut.before").alias("before_fine"))
    cuts = written(_same(coarse.drop("before"), fine, "inner", ("source",)), "mix-cuts")

    if keep_row:
        rows = drawn(docs.select(*plain, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    else:
        rows = sized
    rows = _same(rows, wanted.drop("rest"), "inner", ("source",))
    placed = _same(_ranked(rows, left, "left"), cuts, "left", ("source",))
    certain = F.coalesce(F.col("chance") > F.col("sure"), F.lit(False))
    edge = F.coalesce((F.col("coarse") == F.col("cut_coarse")) & (F.col("fine") == F.col("cut_fine")), F.lit(False))
    below = (F.col("coarse") < F.col("cut_coarse")) | ((F.col("coarse") == F.col("cut_coarse")) & (F.col("fine") < F.col("cut_fine")))
    clear = placed.where(~edge).withColumn("extra", (certain | F.coalesce(below, F.lit(False))).cast("long"))
    # The documents of one bucket of a bucket per source.
    order = Window.partitionBy("source").orderBy("rank", "id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("before_fine")
    close = placed.where(edge).withColumn("extra", (2 * before + F.col("size") <= 2 * F.col("rest")).cast("long"))
    out = ["id", "source", "size", "source_size", "target", (F.col("copies") + F.col("extra")).alias("copies"), *(["row"] if keep_row else [])]
    return clear.select(*out).unionByName(close.select(*out))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it, columns as they are."""
    found = taken(docs, keep_row=True, **options).where("copies > 0 and size > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
