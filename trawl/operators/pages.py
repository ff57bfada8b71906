"""Crawled pages -> domain, text, title, links, summaries, and a corpus for
indexing.  All per-row work is regex Column expressions; the only shuffles are
the explicit distinct/aggregate steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions.text import explode_nonempty


def page_domain(pages: DataFrame) -> DataFrame:
    """(page_id, url, domain); URLs without a host part are skipped."""
    return pages.filter(H.has_host(F.col("url"))).select("page_id", "url", H.url_host(F.col("url")).alias("domain"))


def page_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", H.visible_text(F.col("html")).alias("text"))


def page_title(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", H.title_text(F.col("html")).alias("title"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, href): distinct raw href values per page."""
    return explode_nonempty(pages.select("page_id", H.hrefs(F.col("html")).alias("_l")), "_l", "href", "page_id")


def link_edges(pages: DataFrame, resolve: bool = True, http_only: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, src_url, dst_url) and the columns ``keep``: distinct outgoing links per page.  With
    ``resolve`` relative links are made absolute first; ``http_only`` keeps
    links starting with "http" (the reference follows only those)."""
    links = H.hrefs(F.col("html"))
    if resolve:
        links = F.array_distinct(F.filter(F.transform(links, lambda l: H.resolve(l, F.col("url"))),
                                          lambda l: l.isNotNull()))
    if http_only:
        links = F.filter(links, lambda l: l.startswith("http"))
    return explode_nonempty(pages.select("page_id", F.col("url").alias("src_url"), *keep, links.alias("_l")), "_l", "dst_url",
                            "page_id", "src_url", *keep)


def page_summary(pages: DataFrame, chars: int = 1000, words: int = 20) -> DataFrame:
    """(page_id, title, url, text): the first words of the visible text."""
    return pages.select("page_id", H.title_text(F.col("html")).alias("title"), "url",
                        H.first_words(H.visible_text(F.col("html")), chars, words).alias("text"))


def summary_json(pages: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """(page_id, json): the summary with its time as one JSON line per page."""
    at = F.current_timestamp() if fetched_at is None else fetched_at
    parts = page_summary(pages).withColumn("timestamp", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
    return parts.select("page_id", F.to_json(F.struct("timestamp", "title", "url", "text")).alias("json"))


def successful(fetches: DataFrame, status_col: str = "status", failures: tuple[str, ...] = ("error",)) -> DataFrame:
    """Fetches whose status is not one of ``failures`` (a null status is no success)."""
    return fetches.filter(~F.col(status_col).isin(*failures))


def pages_corpus(pages: DataFrame) -> DataFrame:
    """(doc_id, title, text) for the indexer: page id, title and visible text."""
    return pages.select(F.col("page_id").alias("doc_id"), H.title_text(F.col("html")).alias("title"),
                        H.visible_text(F.col("html")).alias("text"))
