"""The stemmer over Arrow batches: its rules run once per distinct word of a batch, in place, and agree with
the statement of the same rules in SQL."""

import random
import warnings

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from trawl.functions import stem as st
from trawl.operators.index import build_index
from trawl.operators.rank import query_terms, search
from trawl.plans.oracle import CTE_STEM

LISTS = [["running", "skies", None, "running"], None, [], ["running", "", "enjoying"]]
STEMS = [["run", "sky", None, "run"], None, [], ["run", "", "enjoy"]]


def test_rules_run_once_per_distinct_word_of_a_batch(monkeypatch):
    seen, rules = [], st.stem
    monkeypatch.setattr(st, "stem", lambda w: seen.append(w) or rules(w))
    out = st.stem_lists(pa.array([["running", "skies", "running"]] * 1000))
    assert sorted(seen) == ["running", "skies"]
    assert out.to_pylist() == [["run", "sky", "run"]] * 1000


def test_null_empty_sliced_and_large_lists():
    lists = pa.array(LISTS)
    large = lists.cast(pa.large_list(pa.large_string()))
    for given in (lists, large):
        for at in range(len(LISTS) + 1):
            out = st.stem_lists(given[at:])
            assert out.type == given.type and out.to_pylist() == STEMS[at:]


def test_distinct_words_go_through_the_rules_in_slices(monkeypatch):
    monkeypatch.setattr(st, "SLICE", 3)
    words = [f"{chr(97 + i)}runnings" for i in range(20)]
    assert st.stem_lists(pa.array([words, words[::-1]])).to_pylist() == [[st.stem(w) for w in words], [st.stem(w) for w in words[::-1]]]


def test_column_keeps_nulls(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LISTS)], "i int, t array<string>")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        out = df.select("i", st.stem_terms(F.col("t")).alias("s"))
    assert {r.i: r.s for r in out.collect()} == dict(enumerate(STEMS))


def test_stemmed_index_is_one_arrow_pass_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "runs running ran"), (2, ""), (3, None), (None, "sky skies")], "doc_id long, text string")
    post = build_index(docs, stem=True, unique_ids=True, stopwords=None).postings
    plan = post._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert {(r.term, r.doc_id): (r.tf, r.dl) for r in post.collect()} == {
        ("run", 1): (2, 3), ("ran", 1): (1, 3), ("sky", None): (2, 2)}


def test_stemmed_search_stems_documents_and_queries_in_one_arrow_pass_each(spark):
    docs = spark.createDataFrame([(1, "runs running skies"), (2, "sky"), (3, "car"), (4, None), (None, "ran")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "runner run"), (2, "sky sky"), (3, ""), (None, "cars")], "qid long, query string")
    terms = query_terms(queries, stem=True)
    plan = terms._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("ArrowEvalPython") == 1
    assert {(r.qid, r.term): r.qtf for r in terms.collect()} == {(1, "runner"): 1, (1, "run"): 1, (2, "sky"): 2, (None, "car"): 1}
    found = search(queries, build_index(docs, stem=True, unique_ids=True).tokenized_once())
    assert {(r.qid, r.rank, r.doc_id) for r in found.collect()} == {(1, 1, 1), (2, 1, 2), (2, 2, 1), (None, 1, 3)}


def test_same_stems_as_the_sql_rules():
    rnd = random.Random(4)
    ends = [*st.STEP2, *st.STEP3, *st.STEP4, "", "s", "sses", "ied", "ies", "us", "eed", "eedly", "ed", "edly", "ing",
            "ingly", "y", "ly", "logy", "ll", "e", "bbing", "atting", "ized", "ssion"]
    part = lambda n: "".join(rnd.choice("aeiouy" if rnd.random() < 0.5 else "bdglnrstwxyz") for _ in range(rnd.randint(0, n)))
    words = {part(3) + rnd.choice(["", "", "gener", "commun", "arsen"]) + part(4) + rnd.choice(ends) + rnd.choice(["", rnd.choice(ends)])
             for _ in range(20_000)} | {*st.EXCEPTIONS, *st.AFTER_1A, "été", "y", "yy", "yes", "ll", "ée"} - {""}
    rows = duckdb.execute(f"WITH vocab AS (SELECT unnest(?) AS word), {CTE_STEM.strip()} SELECT word, stem FROM stems",
                          [sorted(words)]).fetchall()
    assert len(rows) == len(words)
    assert [(w, s, st.stem(w)) for w, s in rows if st.stem(w) != s] == []
