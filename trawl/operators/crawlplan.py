"""Crawl planning over tables: frontier, robots rules, politeness, budget and
progress.  One crawl round is

  pages -> link_edges -> union seeds -> anti join visited -> distinct
        -> robots filter -> frontier_topn -> fetch_plan

and its result is the next fetch list.  Per-domain ordering uses the
skew-safe ``ordered_position`` (a domain may own a large share of all URLs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.operators.distribute import ordered_position

# The reference's crawl defaults.
DEFAULT_DELAY = 0.1          # seconds between requests to one domain
FRONTIER_SIZE = 1000         # bounded frontier
PROGRESS_EVERY = 50          # progress line every N pages
PAGE_BUDGET = 100_000        # stop after N pages

AGENT = "*"                  # the rules' agent that holds for everyone

# A row per line of a domain's robots file; ``agent`` null means everyone.
RULES_SCHEMA = "domain string, agent string, seq int, allow boolean, prefix string, delay double"


def url_path(url) -> F.Column:
    """Path plus query of an absolute URL ('/' when empty), for robots prefixes."""
    p = F.regexp_extract(url, rf"^{H.SCHEME}://[^/?#]*([^#]*)", 1)
    return F.when(p == "", F.lit("/")).otherwise(p)


def frontier_candidates(seeds: DataFrame, edges: DataFrame, visited: DataFrame) -> DataFrame:
    """(url): seeds plus link targets, minus visited URLs, distinct."""
    cand = seeds.select("url").unionByName(edges.select(F.col("dst_url").alias("url")))
    # De-duplicate first (map-side partial aggregation), so a URL linked from a
    # large share of all pages reaches the anti join once per partition only.
    return cand.distinct().join(visited.select("url"), "url", "left_anti")


def frontier_topn(candidates: DataFrame, size: int = FRONTIER_SIZE) -> DataFrame:
    """(url, prio): the bounded frontier.  The priority is a hash of the URL,
    so the order is random-looking but reproducible; ``orderBy.limit`` plans as
    a per-partition top-N plus a final merge (no full sort)."""
    prio = F.md5(F.col("url"))
    return first_n(candidates.select("url", prio.alias("prio")), size, ["prio", "url"])


def domain_rules(rules: DataFrame, agent: str = AGENT) -> DataFrame:
    """(domain, rules, delay): a row for each domain that has a robots file, its
    rules for ``agent`` in ``seq`` order (those for everyone if it names no rules of
    its own for this agent).  Rows without a prefix and empty Disallow lines match
    nothing.  An array is as long as the file it comes from."""
    who = F.lower(F.coalesce(F.col("agent"), F.lit(AGENT)))
    own, everyone = who == agent.lower(), who == AGENT
    matches = (F.col("prefix") != "") & F.col("allow").isNotNull()
    line = F.struct("seq", "allow", "prefix")
    folded = rules.groupBy("domain").agg(
        F.max(own).alias("_has"),
        F.collect_list(F.when(own & matches, line)).alias("_own"), F.max(F.when(own, F.col("delay"))).alias("_own_delay"),
        F.collect_list(F.when(everyone & matches, line)).alias("_all"), F.max(F.when(everyone, F.col("delay"))).alias("_all_delay"))
    return folded.select(
        "domain", F.array_sort(F.when(F.col("_has"), F.col("_own")).otherwise(F.col("_all"))).alias("rules"),
        F.when(F.col("_has"), F.col("_own_delay")).otherwise(F.col("_all_delay")).alias("delay"))


def robots_filter(urls: DataFrame, rules: DataFrame, agent: str = AGENT) -> DataFrame:
    """(url, domain, delay) of URLs their domain's rules allow.

    Rules are checked in ``seq`` order, the first matching prefix decides,
    no match means allowed.  A domain without any rules row (robots file
    unavailable) is skipped.  A domain's rules are one row, so each URL meets one row
    and is judged where it stands: no pairs of URLs and rules, no grouping of URLs.
    """
    keep = [c for c in urls.columns if c not in ("domain", "delay")]
    u = urls.select(*keep, H.url_host(F.col("url")).alias("domain"), url_path(F.col("url")).alias("_path"))
    j = u.join(domain_rules(rules, agent), "domain")
    first = F.get(F.filter("rules", lambda r: F.col("_path").startswith(r["prefix"])), 0)
    return j.filter(F.coalesce(first["allow"], F.lit(True))).select(*keep, "domain", "delay")


def fetch_plan(allowed: DataFrame, default_delay: float = DEFAULT_DELAY,
               order: tuple[str, ...] = ("prio", "url"), last_requests: DataFrame | None = None,
               bounded: bool = False) -> DataFrame:
    """(domain, url, pos, start_s): earliest start offset of every URL inside
    its domain, ``(pos - 1) * delay``; a delay of 0 or null means the default.
    ``last_requests(domain, age_s)`` tells how long ago a domain was last asked in
    an earlier round; its first URL waits for what is left of the delay.  ``bounded``
    says that ``allowed`` is a cut frontier, whose size a parameter gives: its domains are
    then numbered by a plain window, without writing anything."""
    delay = F.coalesce(F.when(F.col("delay") > 0, F.col("delay")), F.lit(default_delay))
    timed = allowed.withColumn("_delay", delay).withColumn("_wait", F.lit(0.0))
    if last_requests is not None:
        ages = last_requests.groupBy("domain").agg(F.min("age_s").alias("_age")).withColumnRenamed("domain", "_d")
        timed = timed.join(ages, timed["domain"].eqNullSafe(ages["_d"]), "left").withColumn(
            "_wait", F.greatest(F.lit(0.0), F.coalesce(F.col("_delay") - F.col("_age"), F.lit(0.0))))
    if bounded:
        ranked = timed.withColumn("pos", F.row_number().over(Window.partitionBy("domain").orderBy(*order)).cast("long"))
    else:
        ranked = ordered_position(timed, ["domain"], list(order))
    return ranked.select("domain", "url", "pos",
                         F.round(F.col("_wait") + (F.col("pos") - 1) * F.col("_delay"), 6).alias("start_s"))


def politeness_violations(log: DataFrame, min_gap_s: float, domain_col: str = "domain",
                          ts_col: str = "ts", id_col: str = "event_id", gaps: DataFrame | None = None) -> DataFrame:
    """(domain, event_id, gap_s): requests that followed the previous request
    to the same domain sooner than the domain's gap of ``gaps(domain, gap)``, else
    ``min_gap_s`` seconds.  The predecessor is found by position (skew-safe), then an
    equi-join on (domain, position); requests without a domain are one domain."""
    pos = ordered_position(log.select(F.col(domain_col).alias("domain"), F.col(ts_col).alias("ts"),
                                      F.col(id_col).alias("event_id")),
                           ["domain"], ["ts", "event_id"])
    prev = pos.select(F.col("domain").alias("_d"), (F.col("pos") + 1).alias("_p"), F.col("ts").alias("prev_ts"))
    j = pos.join(prev, pos["domain"].eqNullSafe(prev["_d"]) & (pos["pos"] == prev["_p"]))
    gap = (F.unix_micros(F.col("ts")) - F.unix_micros(F.col("prev_ts"))) / F.lit(1e6)
    j = j.select("domain", "event_id", F.round(gap, 6).alias("gap_s"))
    least = F.lit(min_gap_s)
    if gaps is not None:
        own = gaps.groupBy(F.col("domain").alias("_g")).agg(F.max("gap").alias("_gap"))
        j = j.join(own, j["domain"].eqNullSafe(own["_g"]), "left")
        least = F.coalesce(F.col("_gap"), least)
    return j.filter(F.col("gap_s") < least).select("domain", "event_id", "gap_s")


# Up to this many rows a top-N (per-partition top-N, merged in one task) is
# used; larger budgets cut on the skew-safe global position instead, so no
# single task receives n rows from every partition.
MAX_TOP_N = 10_000


def first_n(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in ``order`` (which must be total)."""
    if n <= MAX_TOP_N:
        return df.orderBy(*order).limit(n)
    return ordered_position(df, [], order, out="_pos").filter(F.col("_pos") <= n).drop("_pos")


def crawl_budget(fetches: DataFrame, n: int = PAGE_BUDGET, ts_col: str = "ts",
                 id_col: str = "event_id") -> DataFrame:
    """The first ``n`` successful fetches in time order (the page budget)."""
    return first_n(fetches, n, [ts_col, id_col])


def crawl_progress(fetches: DataFrame, every: int = PROGRESS_EVERY, ts_col: str = "ts",
                   id_col: str = "event_id") -> DataFrame:
    """(pages, elapsed_s, pages_per_s) at every ``every``-th fetch in time order.
    Elapsed time counts from the first fetch."""
    base = fetches.select(F.col(ts_col).alias("ts"), F.col(id_col).alias("event_id"))
    pos = ordered_position(base, [], ["ts", "event_id"], out="pages")
    t0 = base.agg(F.min("ts").alias("_t0"))
    marks = pos.filter(F.pmod(F.col("pages"), F.lit(every)) == 0).crossJoin(F.broadcast(t0))
    elapsed = (F.unix_micros(F.col("ts")) - F.unix_micros(F.col("_t0"))) / F.lit(1e6)
    return marks.select("pages", F.round(elapsed, 3).alias("elapsed_s"),
                        F.round(F.col("pages") / F.nullif(elapsed, F.lit(0.0)), 4).alias("pages_per_s"))


def visited_dedup(edges: DataFrame) -> DataFrame:
    """(url, first_page, copies): one row per link target; the survivor is the
    lowest page id (an aggregate, so a hot URL does not load one task)."""
    return edges.groupBy(F.col("dst_url").alias("url")).agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("copies"))


def pages_per_domain(pages: DataFrame) -> DataFrame:
    return (pages.filter(H.has_host(F.col("url"))).groupBy(H.url_host(F.col("url")).alias("domain"))
            .agg(F.count(F.lit(1)).alias("pages")))


def next_fetch_list(pages: DataFrame, seeds: DataFrame, visited: DataFrame, rules: DataFrame,
                    size: int = FRONTIER_SIZE, default_delay: float = DEFAULT_DELAY,
                    agent: str = AGENT, last_requests: DataFrame | None = None) -> DataFrame:
    """One crawl round: links of the fetched pages plus the seeds, minus what
    was visited, filtered by the robots rules, cut to the bounded frontier and
    spaced per domain.  Returns (domain, url, pos, start_s)."""
    from trawl.operators.pages import link_edges
    cand = frontier_candidates(seeds, link_edges(pages), visited)
    return fetch_plan(robots_filter(frontier_topn(cand, size), rules, agent), default_delay, last_requests=last_requests,
                      bounded=True)
