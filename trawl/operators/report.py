"""Reports over ranking runs.  Inputs are ranked results with a ``ranker``
column: (ranker, qid, rank, doc_id, score); every input is already cut to k
rows per query, so the joins below stay small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def timed(results: DataFrame) -> tuple[DataFrame, float]:
    """``results`` written to the shared scratch folder, and the seconds that took: what
    ``run_report`` wants to know of a ranker's run over a whole batch of queries."""
    from time import perf_counter

    from trawl.session import scratch_path
    spark, path, begin = results.sparkSession, scratch_path(results.sparkSession, "timed"), perf_counter()
    results.write.parquet(path)
    return spark.read.schema(results.schema).parquet(path), perf_counter() - begin


def run_report(queries: DataFrame, ranked: DataFrame, rankers: Sequence[str], qid_col: str = "qid",
               seconds: Mapping[str, float] | None = None) -> DataFrame:
    """Per ranker of ``rankers``, also of one without any result: queries, queries
    with results, total results, results per query, min / max / average score of the
    returned results.  With the ``seconds`` that each ranker's batch took (see ``timed``) also
    total_s, s_per_query and queries_per_s, null for a ranker that was not timed.

    ``ranked`` is read once: one aggregate per (ranker, query) carries the
    count, min, max and sum, and the per-ranker figures are folded from it."""
    per_q = ranked.groupBy("ranker", "qid").agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"),
        F.sum("score").alias("total"))
    hits = per_q.groupBy("ranker").agg(
        F.count(F.lit(1)).alias("with_results"), F.sum("n").alias("total_results"),
        F.min("lo").alias("min_score"), F.max("hi").alias("max_score"),
        F.round(F.sum("total") / F.sum("n"), 4).alias("avg_score"))
    # One row of the number of queries, times the given names.
    named = (queries.agg(F.count(F.lit(1)).alias("queries"))
             .select("queries", F.explode(F.array(*[F.lit(r) for r in rankers])).alias("ranker")))
    total = F.coalesce("total_results", F.lit(0))
    took = []
    if seconds is not None:
        s = F.coalesce(*[F.when(F.col("ranker") == r, F.lit(float(v))) for r, v in seconds.items()], F.lit(None).cast("double"))
        took = [F.round(s, 4).alias("total_s"), F.round(s / F.nullif("queries", F.lit(0)), 6).alias("s_per_query"),
                F.round(F.col("queries") / F.nullif(s, F.lit(0.0)), 2).alias("queries_per_s")]
    return named.join(hits, "ranker", "left").select(
        "ranker", "queries", F.coalesce("with_results", F.lit(0)).alias("with_results"), total.alias("total_results"),
        F.round(total / F.col("queries"), 4).alias("results_per_query"), "min_score", "max_score", "avg_score", *took)


def compare_rankers(ranked: DataFrame, rankers: tuple[str, ...] = ("bm25", "tfidf")) -> DataFrame:
    """Average score of each ranker side by side (one row)."""
    return (ranked.groupBy().pivot("ranker", list(rankers)).agg(F.round(F.avg("score"), 4))
            .select(*[F.col(r).alias(f"{r}_avg_score") for r in rankers]))


def _shared(ranked: DataFrame, a: str, b: str) -> DataFrame:
    """(qid, doc_id) returned by both rankers ``a`` and ``b``: one pass over
    the combined results (each ranker lists a document once per query)."""
    two = ranked.filter(F.col("ranker").isin(a, b))
    return (two.groupBy("qid", "doc_id").agg(F.count_distinct("ranker").alias("_n"))
            .filter(F.col("_n") == 2).select("qid", "doc_id"))


def overlap(queries: DataFrame, ranked: DataFrame, a: str = "bm25", b: str = "tfidf",
            qid_col: str = "qid") -> DataFrame:
    """(qid, shared): number of documents both top-k lists return; 0 included."""
    s = _shared(ranked, a, b).groupBy("qid").agg(F.count(F.lit(1)).alias("shared"))
    q = queries.select(F.col(qid_col).alias("qid"))
    return q.join(s, "qid", "left").select("qid", F.coalesce("shared", F.lit(0)).alias("shared"))


def shared_docs(ranked: DataFrame, a: str = "bm25", b: str = "tfidf") -> DataFrame:
    """(qid, shared_ids): sorted 7-digit ids both rankers return."""
    s = _shared(ranked, a, b).groupBy("qid").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return s.select("qid", F.array_join(F.transform("ids", lambda d: F.format_string("%07d", d)), ",")
                    .alias("shared_ids"))


def best_docs(ranked: DataFrame) -> DataFrame:
    """(ranker, qid, doc_id, score): the best document(s) per query; ties listed."""
    w = Window.partitionBy("ranker", "qid").orderBy(F.col("score").desc())
    return ranked.withColumn("_r", F.rank().over(w)).filter(F.col("_r") == 1).select(
        "ranker", "qid", "doc_id", "score")
