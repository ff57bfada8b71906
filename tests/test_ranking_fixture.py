"""The hand-checked five-document fixture (k1 = 1.5, b = 0.75, no stop words,
no stemming): exact and floor top-k for both rankers."""

import pytest

from trawl.operators.index import build_index
from trawl.operators.rank import search

DOCS = [(1, "red apple"), (2, "red red car"), (3, "green apple pie"), (4, ""), (5, "red apple apple tart")]

EXPECTED = {
    ("red apple", "bm25", "exact"): [(1.1654, 1), (1.0487, 5), (0.7127, 2), (0.4845, 3)],
    ("red apple", "tfidf", "exact"): [(1.3757, 5), (1.0217, 1), (0.8649, 2), (0.5108, 3)],
    ("red red", "bm25", "exact"): [(1.4254, 2), (1.1654, 1), (0.8292, 5)],
    ("red red", "tfidf", "exact"): [(1.7298, 2), (1.0217, 5), (1.0217, 1)],
    ("apple", "bm25", "exact"): [(0.6341, 5), (0.5827, 1), (0.4845, 3)],
    ("apple", "tfidf", "exact"): [(0.8649, 5), (0.5108, 3), (0.5108, 1)],
    ("zebra", "bm25", "exact"): [],
    ("zebra", "tfidf", "exact"): [],
    ("red apple", "bm25", "floor"): [(1.1654, 1)],
    ("red apple", "tfidf", "floor"): [(1.3757, 5), (1.0217, 1)],
    ("red red", "bm25", "floor"): [(1.4254, 2), (1.1654, 1)],
    ("red red", "tfidf", "floor"): [(1.7298, 2), (1.0217, 1)],
    ("apple", "bm25", "floor"): [(0.6341, 5), (0.5827, 1)],
    ("apple", "tfidf", "floor"): [(0.8649, 5), (0.5108, 1)],
    ("zebra", "bm25", "floor"): [],
    ("zebra", "tfidf", "floor"): [],
}
QUERIES = ["red apple", "red red", "apple", "zebra"]


@pytest.fixture(scope="module")
def index(spark):
    corpus = spark.createDataFrame(DOCS, "doc_id long, text string")
    return build_index(corpus, stopwords=None, title_col=None)


@pytest.mark.parametrize("ranker", ["bm25", "tfidf"])
@pytest.mark.parametrize("mode", ["exact", "floor"])
def test_fixture_scores(spark, index, ranker, mode):
    q = spark.createDataFrame(list(enumerate(QUERIES)), "qid long, query string")
    got = {}
    for r in search(q, index, ranker, k=5, mode=mode).collect():
        got.setdefault(r.qid, []).append((r.rank, round(r.score, 4), r.doc_id))
    for qid, text in enumerate(QUERIES):
        rows = sorted(got.get(qid, []))
        assert [(s, d) for _, s, d in rows] == EXPECTED[(text, ranker, mode)], (text, ranker, mode)


def test_stats_keep_empty_document(index):
    row = index.stats.collect()[0]
    assert row.n == 5 and abs(row.avgdl - 2.4) < 1e-12
    assert {r.doc_id: r.dl for r in index.doc_lengths.collect()}[4] == 0


def test_lexicon(index):
    assert {r.term: r.df for r in index.lexicon.collect()} == {
        "red": 3, "apple": 3, "car": 1, "green": 1, "pie": 1, "tart": 1}


def test_all_terms_match(spark, index):
    q = spark.createDataFrame([(0, "red apple")], "qid long, query string")
    docs = [r.doc_id for r in search(q, index, "bm25", k=5, match="all").orderBy("rank").collect()]
    assert docs == [1, 5]


def test_pruned_equals_exact(spark, index):
    q = spark.createDataFrame(list(enumerate(QUERIES)), "qid long, query string")
    for k in (1, 2, 3, 5):
        a = sorted(search(q, index, "bm25", k=k).collect())
        b = sorted(search(q, index, "bm25", k=k, prune=True).collect())
        assert a == b


@pytest.mark.parametrize("ranker,block_docs", [("bm25", 1 << 18), ("bm25", 7), ("tfidf", 25)])
def test_pruned_equals_exact_on_documents(spark, ranker, block_docs):
    """The cut by blocks of documents, with one block and with many, short queries and long."""
    from dataclasses import replace

    from pyspark.sql import functions as F

    from trawl.plans import inputs as inp

    from .conftest import SF_SMALL
    idx = replace(build_index(inp.corpus(spark, SF_SMALL)).tokenized_once(), block_docs=block_docs)
    q = inp.bench_queries(spark, SF_SMALL)
    q = q.unionByName(q.select((F.col("qid") + 1000).alias("qid"), F.substring_index("query", " ", 3).alias("query")))
    for k in (1, 3, 10):
        a = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, idx, ranker, k=k).collect())
        b = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9))
                   for r in search(q, idx, ranker, k=k, prune=True).collect())
        assert a == b


def test_search_many_equals_separate_searches(spark, index):
    from trawl.operators.rank import search_many
    q = spark.createDataFrame(list(enumerate(QUERIES)), "qid long, query string")
    both = search_many(q, index, {"bm25": "bm25", "tfidf": "tfidf"}, k=3).collect()
    for ranker in ("bm25", "tfidf"):
        one = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, index, ranker, k=3).collect())
        many = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in both if r.ranker == ranker)
        assert one == many


def test_written_index_answers_like_in_memory(spark, tmp_dir):
    from trawl.operators.index import Index
    from trawl.plans import inputs as inp

    from .conftest import SF_SMALL
    mem = build_index(inp.corpus(spark, SF_SMALL))
    path = tmp_dir + "/idx"
    mem.write(path, term_buckets=16)
    disk = Index.read(spark, path)
    assert disk.term_buckets == 16
    q = inp.bench_queries(spark, SF_SMALL)
    for ranker in ("bm25", "tfidf"):
        a = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, mem, ranker).collect())
        b = sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in search(q, disk, ranker).collect())
        assert a == b
    small = spark.createDataFrame([(0, "onesen erblest")], "qid long, query string")
    plan = search(small, disk)._jdf.queryExecution().executedPlan().toString()
    import re
    scans = [line for line in plan.splitlines() if "/idx/postings" in line]
    assert scans and all(re.search(r"PartitionFilters: \[tb#\d+ IN \(\d+(,\d+)?\)\]", line) for line in scans)
    assert all("In(term, [erblest,onesen])" in line.split("PushedFilters")[1] for line in scans)


def answers(df):
    return sorted((r.qid, r.rank, r.doc_id, round(r.score, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def blocked(spark):
    """An index of the documents written as small posting blocks, and the queries."""
    import tempfile
    from dataclasses import replace

    from pyspark.sql import functions as F

    from trawl.operators.index import Index
    from trawl.plans import inputs as inp

    from .conftest import SF_SMALL
    path = tempfile.mkdtemp(prefix="trawl-test-") + "/idx"
    replace(build_index(inp.corpus(spark, SF_SMALL), unique_ids=True), block_docs=4).write(path, layout="blocks", term_buckets=3)
    q = inp.bench_queries(spark, SF_SMALL)
    q = q.unionByName(q.select((F.col("qid") + 1000).alias("qid"), F.substring_index("query", " ", 3).alias("query")))
    return Index.read(spark, path), q


def test_blocks_hold_the_same_postings(spark, blocked):
    from trawl.plans import inputs as inp

    from .conftest import SF_SMALL
    index, _ = blocked
    assert index.block_docs == 4 and index.term_buckets == 3
    want = build_index(inp.corpus(spark, SF_SMALL), unique_ids=True)
    cols = ["term", "doc_id", "tf", "dl"]
    assert index.postings.select(cols).exceptAll(want.postings.select(cols)).isEmpty() and index.postings.count() == want.postings.count()
    for table in ("lexicon", "doc_lengths"):
        assert sorted(map(tuple, getattr(index, table).collect())) == sorted(map(tuple, getattr(want, table).collect()))
    sizes = index.blocks().selectExpr("max(n) AS most", "max(size(posts) - n) AS off", "count(*) AS rows", "count(DISTINCT term, block) AS keys").first()
    assert sizes.most <= 20 and sizes.off == 0 and sizes.rows == sizes["keys"] < want.postings.count()


@pytest.mark.parametrize("ranker", ["bm25", "tfidf"])
def test_cut_unpacks_fewer_postings(spark, blocked, monkeypatch, ranker):
    """The cut gives the same answers from fewer postings than the queries' lists have."""
    from trawl.operators import rank as rk
    index, q = blocked
    for k in (2,):
        unpacked, whole = [], rk.term_contributions(q, index, ranker).count()
        want, scored = answers(search(q, index, ranker, k=k)), rk._scored
        monkeypatch.setattr(rk, "_scored", lambda *a: unpacked.append(scored(*a)) or unpacked[-1])
        assert answers(search(q, index, ranker, k=k, prune=True)) == want
        monkeypatch.setattr(rk, "_scored", scored)
        assert sum(x.count() for x in unpacked) < 0.9 * whole


def test_all_terms_over_blocks(spark, blocked, monkeypatch):
    from trawl.operators import rank as rk
    index, q = blocked
    contrib = rk.term_contributions(q, index).toPandas()
    need = {r.qid: r.n for r in rk.query_terms(q).groupBy("qid").count().withColumnRenamed("count", "n").collect()}
    held = contrib.groupby(["qid", "doc_id"]).agg(score=("contrib", "sum"), n=("term", "size")).reset_index()
    want = {(r.qid, r.doc_id): round(r.score, 9) for r in held.itertuples() if need[r.qid] == r.n}
    for gathered in (1024, 1):
        monkeypatch.setattr(rk, "GATHERED", gathered)
        got = {(r.qid, r.doc_id): round(r.score, 9) for r in search(q, index, k=10_000, match="all").collect()}
        assert got == want and len({d for _, d in got}) > 20


def test_a_document_without_id_and_far_ids(spark, tmp_dir):
    from trawl.operators.index import Index
    rows = [(None, "red apple"), (1 << 60, "red red car"), (-5, "green apple pie apple"), (7, ""), (8, "red apple apple tart"), (9, "car red")]
    build_index(spark.createDataFrame(rows, "doc_id long, text string"), unique_ids=True).write(f"{tmp_dir}/i", layout="blocks")
    index = Index.read(spark, f"{tmp_dir}/i")
    q = spark.createDataFrame([(0, "red apple"), (1, "red car apple"), (2, "zebra"), (3, "red zebra"), (4, "")], "qid long, query string")
    assert answers(search(q.filter("qid < 2"), index, k=2, prune=True)) == answers(search(q.filter("qid < 2"), index, k=2))
    both = search(q, index, k=9, match="all").collect()
    assert sorted((r.qid, str(r.doc_id)) for r in both) == [(0, "8"), (0, "None")]


def test_nothing_indexed(spark, tmp_dir):
    from trawl.operators.index import Index
    build_index(spark.createDataFrame([], "doc_id long, text string")).write(f"{tmp_dir}/i", layout="blocks")
    index = Index.read(spark, f"{tmp_dir}/i")
    q = spark.createDataFrame([(0, "red apple")], "qid long, query string")
    assert search(q, index, prune=True).count() == search(q, index, match="all").count() == 0


def test_upper_bounds_from_few_blocks(spark, blocked):
    from trawl.operators import rank as rk
    index, q = blocked
    whole = rk.term_contributions(q, index).groupBy("qid", "term", "qtf").agg({"s": "max"})
    for ranker in ("bm25", "tfidf"):
        want = {(r.qid, r.term): round(r["max(s)"], 9) for r in rk.term_contributions(q, index, ranker).groupBy("qid", "term").agg({"s": "max"}).collect()}
        assert {(r.qid, r.term): round(r.ub, 9) for r in rk.term_upper_bounds(q, index, ranker).collect()} == want
    assert whole.count() == len(want)


def test_report_with_seconds(spark, index):
    from pyspark.sql import functions as F

    from trawl.operators.report import run_report, timed
    q = spark.createDataFrame(list(enumerate(QUERIES)), "qid long, query string")
    found, took = timed(search(q, index, "bm25", k=3))
    rows = {r.ranker: r for r in run_report(q, found.withColumn("ranker", F.lit("bm25")), ("bm25", "none"), seconds={"bm25": took}).collect()}
    assert took > 0 and rows["bm25"].total_s == round(took, 4)
    assert rows["bm25"].s_per_query == pytest.approx(took / len(QUERIES), abs=1e-5) and rows["none"].total_s is None
    assert "total_s" not in run_report(q, found.withColumn("ranker", F.lit("bm25")), ("bm25",)).columns
