"""URL rules and empirical-Bayes host reputation, in native expressions.

Outcomes of labelled pages are counted per host. From the whole down to the suffix, the
registered domain and the host, each level's bad rates are shrunk towards the level
above: the strength of a level's beta prior comes from the spread of its own rates
beyond binomial noise (a moment estimate over all units). A host is blocked if the lower
bound of its posterior bad rate exceeds a multiple of the rate of all pages; a host with no labelled page takes
the posterior of its domain, suffix or the whole only if one of its pages is judged, and
with the same bound.

Results: a null url, or one without ``://``, has an empty host and path, fits no rule
and is judged like any host. Ports are part of the host, but not of its domain; an address is a
domain of its own. An outcome that is null is no label. Rows that repeat count
as often as they occur. Without any outcome nothing is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import free_names, lookup_join, lowered, quoted, without, written

BOUND = 2.0  # times the rate of all pages
DEVIATIONS = 1.96
LEAST_SPREAD, MOST_SPREAD = 1e-4, 0.5


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """A struct of the longest fitting rule's text and verdict, else null."""
    found = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        fits = fits & path.startswith(rule.path)
        chosen = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = found.when(fits, chosen)
    return found


def bare_host(host: Column) -> Column:
    """Without a port."""
    return F.regexp_replace(host, r":[0-9]*$", "")


def is_address(bare: Column) -> Column:
    """An IPv4 address or one in brackets: it has no domain above it."""
    return bare.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|^\[.*\]$")


def host_suffix(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The longest listed suffix, else the last label; an address is its own."""
    bare = bare_host(host)
    found = F.when(is_address(bare), bare)
    for suffix in sorted(suffixes, key=lambda x: (-x.count("."), x)):
        found = found.when((bare == suffix) | bare.endswith("." + suffix), F.lit(suffix))
    return found.otherwise(F.substring_index(bare, ".", -1))


def host_domain(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The suffix with one label before it; an address is its own."""
    bare, by_labels = bare_host(host), F.substring_index(bare_host(host), ".", -2)
    found = F.when(is_address(bare), bare)
    for suffix in sorted(suffixes, key=lambda x: (-x.count("."), x)):
        listed = (bare == suffix) | bare.endswith("." + suffix)
        found = found.when(listed, F.substring_index(bare, ".", -(suffix.count(".") + 2)))
    return found.otherwise(by_labels)


def _strength(units: DataFrame) -> float:
    """Prior observations of a level whose lines have n, bad and the mean above (prior)."""
    noise = F.col("prior") * (1 - F.col("prior"))
    off = F.col("bad") / F.col("n") - F.col("prior")
    row = units.where("n > 0").agg(
        F.sum(F.col("n") * off * off).alias("seen"),
        F.sum(noise).alias("binomial"),
        F.sum(noise * (F.col("n") - 1)).alias("room"),
    ).first()
    spread = 0.0
    if row["room"]:
        spread = (row["seen"] - row["binomial"]) / row["room"]
    return 1 / min(max(spread, LEAST_SPREAD), MOST_SPREAD) - 1


def _shrunk(units: DataFrame, strength: float) -> Column:
    return (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)


def host_reputation(
    outcomes: DataFrame,
    *,
    host: str = "host",
    bad: str = "bad",
    deviations: float = DEVIATIONS,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """One line per host: n, bad, prior mean, posterior mean, its lower bound, and the rate of all pages.

    ``outcomes``: one row per page with its host and a boolean, null where not labelled.
    ``suffixes``: those of several labels (like ``co.uk``) under which domains are registered.
    """
    hosts = written(
        outcomes.groupBy(quoted(host).alias("host")).agg(
            F.count(quoted(bad)).alias("n"), F.count_if(quoted(bad)).alias("bad")
        ),
        "host-outcomes",
    ).withColumns({"domain": host_domain(F.col("host"), suffixes), "suffix": host_suffix(F.col("host"), suffixes)})
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    rate = total[1] / total[0] if total[0] else 0.0
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]

    tops = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(rate))
    above = tops.select("suffix", _shrunk(tops, _strength(tops)).alias("prior"))
    domains = written(hosts.groupBy("domain", "suffix").agg(*sums), "domain-outcomes")
    domains = lookup_join(domains, written(above, "suffix-rates"), "suffix", "domain")
    above = domains.select("domain", _shrunk(domains, _strength(domains)).alias("prior"))
    units = written(
        lookup_join(hosts, written(above, "domain-rates"), "domain", "host"), "host-priors"
    )
    strength = _strength(units)
    mean, weight = _shrunk(units, strength), F.col("n") + strength
    lower = F.greatest(F.lit(0.0), mean - deviations * F.sqrt(mean * (1 - mean) / (weight + 1)))
    return units.select("host", "n", "bad", "prior", mean.alias("posterior"), lower.alias("lower_bound"), F.lit(rate).alias("rate"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    bad: Column,
    *,
    url: str = "url",
    page_id: str = "page_id",
    bound: float = BOUND,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """The pages with host, path, rule, verdict and their host's n, bad, posterior and lower_bound.

    ``bad`` is the outcome of a page (null: not labelled). A host without a rule is blocked if
    its lower bound exceeds ``bound`` times the rate of all pages.
    """
    (outcome,) = free_names(pages, "outcome")
    address = quoted(url)
    reputation = host_reputation(
        pages.select(url_host(address).alias("host"), bad.alias(outcome)), bad=outcome, suffixes=suffixes
    )
    added = ("host", "path", "rule", "verdict", "n", "bad", "posterior", "lower_bound")
    kept = pages.select(*map(quoted, without(pages, *added)))
    match, rate = free_names(kept, "matched_rule", "page_rate")
    reputation = reputation.select("host", "n", "bad", "posterior", "lower_bound", F.col("rate").alias(rate))
    parsed = kept.withColumns({"host": url_host(address), "path": url_path(address)}).withColumn(
        match, matching_rule(F.col("host"), F.col("path"), rules)
    )
    joined = lookup_join(parsed, reputation, "host", page_id)
    blocked = F.coalesce(F.col("lower_bound") > bound * F.col(rate), F.lit(False))
    return joined.select(
        *map(quoted, kept.columns),
        "host",
        "path",
        F.col(f"{match}.rule").alias("rule"),
        F.coalesce(
            F.col(f"{match}.verdict"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
        "n",
        "bad",
        "posterior",
        "lower_bound",
    )
