"""Sums by (query, document) without a shuffle of them, floors that change no answer, folds dealt out by document."""

import re

import pytest
from pyspark.sql import functions as F

from trawl.operators import rank as rk
from trawl.operators.index import Index, build_index, doc_terms, merge_partials, postings_with_lengths
from trawl.sources.index_store import postings_tasks

DOCS = "doc_id long, text string"


def dealt_by(df):
    """The columns of every exchange of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.findall(r"([a-z_]+)#", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies (equal scores), a document without id, lengths that repeat; queries known, unknown and empty."""
    words = ["red", "car", "pie", "tart", "apple", "green", "tree", "road"]
    rows = [(i, " ".join(words[(i * j + j) % (3 + i % 6)] for j in range(1, 3 + i % 7))) for i in range(400)]
    rows += [(1000 + i, "red car pie") for i in range(60)] + [(None, "red tart"), (5000, "")]
    queries = [(1, "red car"), (2, "pie pie tart apple"), (3, "zzz"), (4, ""), (5, "road"), (6, "red car pie")]
    return build_index(spark.createDataFrame(rows, DOCS), stopwords=None, unique_ids=True).tokenized_once(), \
        spark.createDataFrame(queries, "qid long, query string")


def falling(tf, df, dl, n, avgdl):
    """A ranker whose scores fall with every term, some below zero."""
    return F.lit(0.4) - tf / (dl + 1.0)


@pytest.mark.parametrize("ranker", ["bm25", "tfidf", falling])
@pytest.mark.parametrize("k", [1, 10, 100])
def test_floors_change_no_answer(corpus, ranker, k):
    index, q = corpus
    key = lambda r: (r.qid, r["rank"], r.doc_id, round(r.score, 9))
    want = rk.top_k(rk.score_documents(rk.term_contributions(q, index, ranker)), k)
    assert sorted(map(key, rk.search(q, index, ranker, k=k).collect()), key=str) == sorted(map(key, want.collect()), key=str)
    both = rk.search_many(q, index, {"a": ranker, "b": "bm25"}, k=k).filter("ranker = 'a'")
    assert sorted(map(key, both.collect()), key=str) == sorted(map(key, want.collect()), key=str)


def test_sums_are_not_shuffled(corpus):
    index, q = corpus
    for found in (rk.search(q, index), rk.search(q, index, "tfidf"), rk.search_many(q, index, {"a": "bm25", "b": "tfidf"})):
        assert ["doc_id"] in dealt_by(found) and not [x for x in dealt_by(found) if {"qid", "doc_id"} <= {*x}]


def test_few_sums_are_ranked(corpus):
    index, q = corpus
    scored = rk.score_documents(rk.term_contributions(q, index))
    floors = rk._floors(rk.score_documents(rk.term_contributions(q, Index(
        rk._first_docs(index.postings)[0], index.lexicon, index.doc_lengths, stopwords=None, stats_table=index.stats))), 3, "qid")
    assert rk._reaching(scored, floors, "qid").count() < 0.7 * scored.count()


def test_cut_stores_and_shuffles_no_sums_below_the_floor(spark, corpus, tmp_dir, monkeypatch):
    index, q = corpus
    index.write(f"{tmp_dir}/i", layout="blocks")
    stored, written = {}, rk._written
    monkeypatch.setattr(rk, "_written", lambda df, name: stored.setdefault(name, df) is None or written(df, name))
    opened = Index.read(spark, f"{tmp_dir}/i")
    found = {(r.qid, r["rank"], r.doc_id) for r in rk.search(q, opened, k=2, prune=True).collect()}
    assert found == {(r.qid, r["rank"], r.doc_id) for r in rk.search(q, index, k=2).collect()}
    for name in ("first-sums", "rare-sums"):
        assert not [x for x in dealt_by(stored[name]) if {"qid", "doc_id"} <= {*x}]
    assert stored["rare-sums"].count() < rk.score_documents(rk.term_contributions(q, index)).count()


def test_partials_are_folded_by_document(spark):
    part = lambda rows, n: postings_with_lengths(doc_terms(spark.createDataFrame(rows, DOCS), stopwords=None, title_col=None)).withColumn("part_no", F.lit(n))
    merged = merge_partials(part([(1, "red car"), (2, "pie"), (None, "a b")], 0).unionByName(part([(1, "red red pie"), (None, "a a")], 1)))
    assert not [x for x in dealt_by(merged) if "term" in x]
    assert {(x.term, x.doc_id): (x.tf, x.dl) for x in merged.collect()} == {
        ("red", 1): (2, 3), ("car", 1): (1, 3), ("pie", 1): (1, 3), ("", 1): (1, 3), ("pie", 2): (1, 1), ("", 2): (1, 1),
        ("a", None): (2, 2), ("b", None): (1, 2), ("", None): (1, 2)}


def test_a_task_takes_a_bounded_share_of_the_postings(spark):
    assert postings_tasks(spark.range(1 << 25)) >= (8 << 25) // (4 << 20)  # 8 bytes a row


@pytest.mark.parametrize("ranker", ["bm25", falling])
def test_more_queries_are_scored_by_more_tasks(spark, corpus, monkeypatch, ranker):
    """A task's hash maps hold its documents times the queries: sized by the input alone they grow with the queries."""
    index, _ = corpus
    q = spark.createDataFrame([(i, "red car pie road") for i in range(60)] + [(None, "tart"), (None, "red")], "qid long, query string")
    pairs = rk.score_documents(rk.term_contributions(q, index, "bm25")).count()
    monkeypatch.setattr(rk, "SUMS_PER_TASK", 500, raising=False)
    key = lambda r: (r.qid, r["rank"], r.doc_id, round(r.score, 9))
    want = sorted(map(key, rk.top_k(rk.score_documents(rk.term_contributions(q, index, ranker)), 10).collect()), key=str)
    both = rk.search_many(q, index, {"a": ranker, "b": "bm25"})
    for found, rows in ((rk.search(q, index, ranker), None), (both, both.filter("ranker = 'a'"))):
        tasks = re.findall(r"Exchange hashpartitioning\(doc_id#\d+L, (\d+)\), REPARTITION_BY_NUM", found._jdf.queryExecution().executedPlan().toString())
        assert tasks and all(int(n) >= pairs // 500 for n in tasks)
        assert sorted(map(key, (found if rows is None else rows).collect()), key=str) == want
