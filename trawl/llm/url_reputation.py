"""URL filter: rules first, then the reputation of the host by empirical Bayes.

Pages with a known outcome (good or bad) are counted per host.  A host's share of bad
pages is a beta-binomial: its prior is centred on its registered domain's share, the
domain's on its public suffix', the suffix' on the share over all pages.  How much a
prior weighs follows from the data by moments: the less the children of a level differ
beyond chance, the more they are shrunk.  A page is blocked if the lower bound of its
host's posterior share exceeds ``MAX_BAD``: a host with few labels stays near its
parents and is let through unless they are bad, one with many speaks for itself.

Everything is DataFrame operations: outcomes are summed per host before any shuffle, so
a host with a third of all pages is one row per task; upper levels are sums of sums.

Defined results: a null URL, or one without "://", has empty host and path, belongs to
no domain and is judged by the share over all pages; an outcome counts once for each
page row of its id; without any outcome nothing but the rules blocks; equal rows get
equal results; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import UPPER, stored

#: Fixed values: (verdict, rule) of the production rules.
RULES: tuple[tuple[str, str], ...] = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
)
#: Public suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
                      "or.jp", "com.br", "com.cn", "com.mx", "co.in", "co.kr", "co.za", "com.tr", "com.ar", "com.tw")
MAX_BAD = 0.5
#: Standard deviations from the posterior mean to its bound (one-sided 95 %).
BOUND_Z = 1.645
#: Pseudo-counts of a prior, at least and at most.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0
#: Prior of the share over all pages: one bad of two.
TOP_BAD, TOP_ALL = 1.0, 2.0


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more; the host itself if it has no more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct<verdict, rule>`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def _shrunk(children: DataFrame) -> DataFrame:
    """``children(.., bad, n, mean)`` with the posterior ``a``, ``b`` under the parents'
    means; the prior's weight comes from the spread of all children around them.

    With share s = bad / n, E (s - m)^2 = m (1 - m) (1 / n + (1 - 1 / n) / (w + 1)) for
    a prior of mean m and weight w; summed over the children with n labels each and
    solved for w.  Two sums reach the driver.
    """
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), 2)
    chance = F.col("mean") * (1 - F.col("mean"))
    sums = children.where("n > 0").agg(F.sum(spread - chance).alias("over"), F.sum(chance * (F.col("n") - 1)).alias("most")).first()
    weight = MOST_WEIGHT
    if sums.over is not None and sums.over > 1e-12:
        weight = max(LEAST_WEIGHT, min(MOST_WEIGHT, sums.most / sums.over - 1))
    return (children.withColumn("a", weight * F.col("mean") + F.col("bad"))
            .withColumn("b", weight * (1 - F.col("mean")) + F.col("n") - F.col("bad")).drop("mean"))


def _mean(level: DataFrame, on: list[str]) -> DataFrame:
    return level.select(*on, (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"))


def reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``(host, n_labelled, n_bad, bad_mean, bad_low)`` for every host of
    ``pages(page_id, url)``; ``outcomes(page_id, bad)`` has 0 or 1 per known page."""
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    seen = pages.select("page_id", host_of(F.col("url")).alias("host")).join(known, "page_id", "left")
    hosts = stored(seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                   .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))),
                   "reputation-hosts")
    total = lambda df, *on: df.groupBy(*on).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = stored(total(hosts, "suffix", "domain"), "reputation-domains")
    suffixes = stored(total(domains, "suffix"), "reputation-suffixes")
    top = total(suffixes).first()
    by_suffix = _shrunk(suffixes.withColumn("mean", F.lit(((top.bad or 0) + TOP_BAD) / ((top.n or 0) + TOP_ALL))))
    by_domain = _shrunk(domains.join(_mean(by_suffix, ["suffix"]), "suffix"))
    by_host = _shrunk(hosts.join(_mean(by_domain, ["suffix", "domain"]), ["suffix", "domain"]))
    size = F.col("a") + F.col("b")
    mean = F.col("a") / size
    low = F.greatest(F.lit(0.0), mean - BOUND_Z * F.sqrt(mean * (1 - mean) / (size + 1)))
    return by_host.select("host", F.col("n").alias("n_labelled"), F.col("bad").cast("long").alias("n_bad"),
                          F.round(mean, 6).alias("bad_mean"), F.round(low, 6).alias("bad_low"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          max_bad: float = MAX_BAD) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, n_labelled, n_bad, bad_mean, bad_low)``,
    one row per row of ``pages``."""
    standing = stored(reputation(pages, outcomes), "reputation")
    url = F.col("url")
    judged = (pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
              .withColumn("fit", matched_rule(F.col("host"), F.col("path"), rules)))
    verdict = F.coalesce("fit.verdict", F.when(F.col("bad_low") > max_bad, "block").otherwise("allow"))
    return judged.join(standing, "host").select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
        "n_labelled", "n_bad", "bad_mean", "bad_low")
