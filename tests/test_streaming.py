"""Incremental indexing: partial per batch, a retried batch replaces its own
part, and the merge equals the batch index."""

from pyspark.sql import functions as F

from trawl.operators.index import build_index
from trawl.plans import inputs as inp
from trawl.streaming.incremental import merge, partial_writer

from .conftest import SF_SMALL


def test_partials_are_idempotent_and_merge_to_postings(spark, tmp_dir):
    corpus = inp.corpus(spark, SF_SMALL)
    parts = tmp_dir + "/parts"
    write = partial_writer(parts)
    lo = corpus.filter(F.col("doc_id") % 2 == 0)
    hi = corpus.filter(F.col("doc_id") % 2 == 1)
    write(lo, 0)
    write(hi, 1)
    write(hi, 1)  # a retried micro-batch
    got = merge(spark, parts).select("term", "doc_id", "tf", "dl")
    exp = build_index(corpus).postings.select("term", "doc_id", "tf", "dl")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_later_part_wins(spark, tmp_dir):
    parts = tmp_dir + "/parts2"
    write = partial_writer(parts, title_col=None)
    write(spark.createDataFrame([(1, "red apple"), (2, "pie")], "doc_id long, text string"), 0)
    write(spark.createDataFrame([(1, "red red")], "doc_id long, text string"), 1)
    got = {(r.term, r.doc_id): r.tf for r in merge(spark, parts).collect()}
    assert got == {("red", 1): 2, ("apple", 1): 1, ("pie", 2): 1}


def test_progress_keeps_every_row_in_any_file_order(spark, tmp_dir):
    """Hourly events in four files, read one file per batch, the newest first."""
    import os
    import time

    from trawl.streaming import progress, runner

    src = tmp_dir + "/events"
    for n, lo in enumerate((36, 24, 12, 0)):
        (spark.range(lo, lo + 12).selectExpr("timestamp'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts")
         .coalesce(1).write.mode("append").parquet(src))
        for f in os.listdir(src):
            if f.startswith("part-") and not os.path.exists(f"{src}/.seen-{f}"):
                open(f"{src}/.seen-{f}", "w").close()
                os.utime(f"{src}/{f}", (time.time() - 1000 + n, time.time() - 1000 + n))
    stream = runner.file_stream(spark, src, maxFilesPerTrigger="1")
    out = runner.run_updates(progress.progress_windows(stream, window="2 hours"), "progress-test", progress.KEYS)
    rows = out.collect()
    assert len(rows) == 24 and all(r.fetches == 2 for r in rows)


def test_progress_of_nothing(spark, tmp_dir):
    from trawl.streaming import progress, runner

    spark.createDataFrame([], "ts timestamp").write.parquet(tmp_dir + "/none")
    stream = runner.file_stream(spark, tmp_dir + "/none")
    assert runner.run_updates(progress.progress_windows(stream), "progress-none", progress.KEYS).count() == 0


def test_merged_index_is_searchable(spark, tmp_dir):
    from trawl.operators.index import Index
    from trawl.operators.rank import search
    from trawl.streaming.incremental import merged_index

    parts, corpus = tmp_dir + "/parts3", inp.corpus(spark, SF_SMALL)
    write = partial_writer(parts)
    write(corpus.filter("doc_id % 3 = 0"), 0)
    write(corpus.filter("doc_id % 3 <> 0"), 1)
    index = merged_index(spark, parts)
    index.write(tmp_dir + "/merged")
    q = inp.bench_queries(spark, SF_SMALL)
    want = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, build_index(corpus)).collect())
    for i in (index, Index.read(spark, tmp_dir + "/merged")):
        assert sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, i).collect()) == want
