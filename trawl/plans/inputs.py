"""How the operators are fed from the shared test tables.

documents  -> corpus (doc_id, title = '', text)
benchmark  -> queries (qid = item_id, query = the whole passage text)
pages      -> crawled pages (page_id, url, html)
events     -> request log (user_id as the domain, event_type 'error' = failure)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOP_K = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from trawl.sources.tables import read_parquet
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.lit("").alias("title"), "text")


def bench_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("qid"), F.col("text").alias("query"))


# Extra query lines of the fixture set -- stop words only, an
# unknown word, a repeated word, an empty line.
EXTRA_QUERIES: tuple[tuple[int, str], ...] = (
    (-1, "the of and"),
    (-2, "zzyzxq"),
    (-3, "der der der"),
    (-4, ""),
)


def extra_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EXTRA_QUERIES), "qid long, query string")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log with a session-zone timestamp (the parquet column is NTZ)."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
