"""URL filter: fixed rules first, then the reputation of the host.

Labelled page outcomes are counted per host and shrunk through three levels: the suffix
towards all pages, the registered domain towards its suffix, the host towards its domain.
The strength of each prior is estimated from how much the children of a level differ
(moments of the beta-binomial).  A page is blocked when the lower posterior bound of its
host's share of good pages is below ``least``.

Outcomes are summed per host into a table before anything is joined; pages join the table of hosts on
the host, where the adaptive skew join splits a host with a third of all pages.

Defined cases: a null url, or one without ``://``, has an empty host and path; hosts
without outcomes get their domain's posterior; without any outcome the share of good
pages counts as one half with strength 2; repeated page ids are rows like any other;
outcomes with a null id or a null value are ignored; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstream.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_GOOD = 0.5
# Standard deviations below the posterior mean: about the 5 % quantile.
BELOW = 1.645
# Bounds of the correlation of outcomes within a group.
LEAST_RHO, MOST_RHO = 0.001, 0.5


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        here = (host == self.host) | host.endswith("." + self.host)
        return here & path.startswith(self.path)


# The rules the filter starts with.
RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``page_id, host, path`` of every page."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return pages.select(
        "page_id", host.alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path")
    )


def registered_domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def strength(groups: DataFrame, mean: float) -> float:
    """Prior strength of a level from the spread of its groups' shares (``good``, ``n``)."""
    spread = mean * (1 - mean)
    row = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.lit(mean), 2)).alias("q"),
    ).first()
    if not row["m"] or spread <= 0:
        return 1 / MOST_RHO - 1
    free = row["n"] - row["nn"] / row["n"] - (row["m"] - 1)
    rho = (row["q"] / spread - (row["m"] - 1)) / free if free > 0 else LEAST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``host, good, n, mean, bound`` from outcomes summed per host (``host, good, n``)."""
    hosts = outcomes.select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"), "good", "n"
    )
    total = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = total["good"] / total["n"] if total["n"] else 0.5
    sums = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    if not total["n"]:
        at_suffix = at_domain = at_host = 2.0
    else:
        at_suffix, at_domain, at_host = (strength(g, mean) for g in (suffixes, domains, hosts))

    def shrunk(prior: Column, m: float) -> Column:
        return (F.col("good") + F.lit(m) * prior) / (F.col("n") + F.lit(m))

    by_suffix = suffixes.select("suffix", shrunk(F.lit(mean), at_suffix).alias("prior"))
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", shrunk(F.col("prior"), at_domain).alias("prior")
    )
    a = F.col("good") + F.lit(at_host) * F.col("prior")
    size = F.col("n") + F.lit(at_host)
    share = a / size
    deviation = F.sqrt(share * (1 - share) / (size + 1))
    return hosts.join(by_domain, "domain").select(
        "host", "good", "n", share.alias("mean"), (share - F.lit(BELOW) * deviation).alias("bound")
    )


def verdicts(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[UrlRule] = RULES, least: float = LEAST_GOOD
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bound``; ``outcomes`` are ``page_id, good``."""
    parts = with_parts(pages)
    known = outcomes.where("page_id is not null and good is not null").select(
        F.col("page_id").alias("_id"), F.col("good").cast("bigint").alias("good")
    )
    # Pages without outcomes add nothing but their host, and need not meet by their id.
    outcome = parts.join(known, parts["page_id"] == known["_id"]).select("host", "good", F.lit(1).alias("n"))
    none = parts.select("host", F.lit(0).cast("bigint").alias("good"), F.lit(0).alias("n"))
    sums = outcome.unionByName(none).groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    # Read for the totals, the three strengths and the result.
    per_host = written(sums, "host-outcomes")
    scored = host_reputation(per_host).select("host", "bound")
    longest = sorted(rules, key=lambda r: (-len(r.rule), r.rule))

    def chosen(value) -> Column:
        host, path = F.col("host"), F.col("path")
        start = F.when(F.lit(False), F.lit(None).cast("string"))
        return reduce(lambda c, r: c.when(r.fits(host, path), F.lit(value(r))), longest, start)

    by_host = F.when(F.col("bound") >= F.lit(least), F.lit("allow")).otherwise(F.lit("block"))
    return (
        parts.withColumn("rule", chosen(lambda r: r.rule))
        .withColumn("_ruled", chosen(lambda r: r.verdict))
        .join(scored, "host")
        .select("page_id", "host", "path", "rule", F.coalesce("_ruled", by_host).alias("verdict"), "bound")
    )
