"""URL filter: rules first, then the reputation of the host.

Labelled page outcomes are counted per host, registered domain, suffix and overall.  The suffix
is the last label of the host, or its last two where a table of suffixes names them; the
registered domain has one label more.  A user name and a port are no part of a host here.  A host's share of bad
pages has a beta-binomial posterior whose prior is its domain's posterior mean;
the domain's prior comes from its suffix in the same way, the suffix's from all
pages.  How strongly a level is drawn to the one above is estimated from the
spread between its members (method of moments).  A page is blocked if even a low
bound of its host's share of bad pages is high.

Everything is an aggregate by host and a join back on host.  One host may hold a
large part of all pages: the counts are added up before they are shuffled, and
the join is a plain one, which Spark splits at such a key or broadcasts if it
finds the hosts small enough.

Defined results: a null url, or one without ``://``, has an empty host and path;
it fits no rule unless the rule is empty.  Hosts without labelled pages have
their prior.  Repeated pages give repeated rows; without any label every page
without a rule is allowed.  An empty table gives no rows, and the length of urls does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import written

# A host goes if its share of bad pages is above BLOCK_ABOVE, by a bound BOUND_WIDTH
# posterior standard deviations below the mean.
BLOCK_ABOVE = 0.5
BOUND_WIDTH = 1.645

# Limits of the estimated strength of a prior, in pages, and the digits it is rounded to.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0

# Suffixes of two labels, below which names are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr",
    "com.br", "com.mx", "com.ar", "com.cn", "com.tw", "com.tr", "co.in", "co.za", "com.sg", "com.hk",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, a beginning of the path, and what happens to such pages."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """A host without the user name before it and the port behind it."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def suffix_and_domain(site: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """The suffix of a site and its registered domain; a site that is no more than a suffix is its own domain."""

    def last(labels: int) -> Column:
        return F.substring_index(site, ".", -labels)

    two = last(2).isin(list(suffixes)) if suffixes else F.lit(False)
    return F.when(two, last(2)).otherwise(last(1)), F.when(two, last(3)).otherwise(last(2))


def _best(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """The longest rule that fits; of equally long ones the first in the alphabet."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict), reverse=True):
        found = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(found)
    return found


def _strength(level: DataFrame, parent: str) -> DataFrame:
    """One row: the strength of the prior that members of a level take from their parents."""
    exact = "decimal(28,6)"
    n, k = F.col("n"), F.col("k")
    parts = level.groupBy(parent).agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.count(F.lit(1)).alias("members"),
        F.sum((k * k / n).cast(exact)).cast("double").alias("kk"),
        F.sum((n * n).cast("decimal(38,0)")).cast("double").alias("nn"),
    )
    noise = (F.col("members") - 1) * k * (n - k) / (n * n)
    between = F.col("kk") - k * k / n - noise
    total = parts.agg(
        F.sum(between.cast(exact)).cast("double").alias("between"),
        F.sum((n - F.col("nn") / n).cast(exact)).cast("double").alias("size"),
        F.sum((k * (n - k) / n).cast(exact)).cast("double").alias("inside"),
        F.sum("n").cast("double").alias("n"),
    )
    # Variance between members as a share of a single page's variance.
    share = F.try_divide(F.col("between") * F.col("n"), F.col("size") * F.col("inside"))
    strength = F.when(share > 0, F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), 1 / share - 1)))
    return total.select(F.round(F.coalesce(strength, F.lit(MOST_STRENGTH)), 3).alias("strength"))


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Posterior mean and low bound of the share of bad pages, per site of (host, bad) rows."""
    suffix, domain = suffix_and_domain(F.col("host"), suffixes)
    counted = (
        outcomes.where("bad in (0, 1)")
        .groupBy(site_of(F.col("host")).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").cast("long").alias("k"))
    )
    # Every level is made from this table, which is read instead of counted again.
    hosts = written(counted.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix"), F.lit("").alias("all")), "host-counts")
    levels = {"host": hosts}
    for name, below in ((["domain", "suffix", "all"], "host"), (["suffix", "all"], "domain"), (["all"], "suffix")):
        levels[name[0]] = levels[below].groupBy(*name).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    above = levels["all"].select("all", (F.col("k") / F.col("n")).alias("above"))
    for name, parent in (("suffix", "all"), ("domain", "suffix"), ("host", "domain")):
        one = _strength(levels[name], parent)
        found = levels[name].join(above, parent).join(F.broadcast(one))
        size = F.col("n") + F.col("strength")
        mean = (F.col("k") + F.col("strength") * F.col("above")) / size
        above = found.select(name, mean.alias("above"), size.alias("size")).drop(*([] if name == "host" else ["size"]))
    mean = F.col("above")
    bound = mean - BOUND_WIDTH * F.sqrt(mean * (1 - mean) / (F.col("size") + 1))
    return above.select("host", mean.alias("mean"), bound.alias("bound"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    block_above: float = BLOCK_ABOVE,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Host, path, rule and verdict of every page; ``outcomes`` has (host, bad) rows."""
    host, path = host_and_path(F.col(url_column))
    found = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    ruled = found.withColumns({
        "rule": _best(rules, F.col("host"), F.col("path"), lambda r: r.text),
        "ruling": _best(rules, F.col("host"), F.col("path"), lambda r: r.verdict),
    })
    known = host_reputation(outcomes, suffixes).select(F.col("host").alias("site"), F.col("bound").alias("bad_bound"))
    learned = F.when(F.col("bad_bound") > block_above, "block").otherwise("allow")
    return ruled.withColumn("site", site_of(F.col("host"))).join(known, "site", "left").select(
        id_column, "host", "path", "rule", F.coalesce("ruling", learned).alias("verdict")
    )
