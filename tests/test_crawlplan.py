"""Robots rules, politeness and reports: cases that the test tables do not hold."""

from datetime import datetime, timedelta

from trawl.operators import crawlplan as cp
from trawl.operators import report as rp
from trawl.operators.pages import successful, summary_json

RULES = [
    ("empty.x", "*", 1, False, "", 1.0),
    ("first.x", None, 1, True, "/a/b", None), ("first.x", "*", 2, False, "/a", None),
    ("agent.x", "*", 1, False, "/", 9.0), ("agent.x", "Bot", 1, False, "/private", 2.0),
    ("other.x", "someone", 1, False, "/", 3.0),
    ("only.x", None, 1, None, None, 4.0),
]
URLS = ["http://empty.x/p", "http://first.x/a/b/c", "http://first.x/a/c", "http://first.x", "http://agent.x/open", "http://agent.x/private/1",
        "http://other.x/p", "http://only.x/p?q=1", "http://norules.x/p"]


def allowed(spark, agent):
    rules = spark.createDataFrame(RULES, cp.RULES_SCHEMA)
    urls = spark.createDataFrame([(u,) for u in URLS], "url string")
    out = cp.robots_filter(urls, rules, agent)
    assert "Aggregate" not in str(out._jdf.queryExecution().optimizedPlan()).split("Join")[0]
    return {r.url[7:]: r.delay for r in out.collect()}


def test_robots(spark):
    shared = {"empty.x/p": 1.0, "first.x/a/b/c": None, "first.x": None, "other.x/p": None, "only.x/p?q=1": 4.0}
    assert allowed(spark, "*") == shared
    assert allowed(spark, "bot") == shared | {"agent.x/open": 2.0}
    assert allowed(spark, "SomeOne") == {k: v for k, v in shared.items() if k != "other.x/p"}


def test_fetch_plan_waits_for_the_last_request(spark):
    rows = [("a", f"u{i}", 2.0) for i in range(3)] + [("b", "v", None), ("c", "w", 0.0), (None, "n", 1.0)]
    todo = spark.createDataFrame(rows, "domain string, url string, delay double").selectExpr("*", "url AS prio")
    last = spark.createDataFrame([("a", 0.5), ("a", 9.0), ("b", 50.0), (None, 0.25)], "domain string, age_s double")
    got = {(r.domain, r.url): r.start_s for r in cp.fetch_plan(todo, 0.1, last_requests=last).collect()}
    assert got == {("a", "u0"): 1.5, ("a", "u1"): 3.5, ("a", "u2"): 5.5, ("b", "v"): 0.0, ("c", "w"): 0.0, (None, "n"): 0.75}
    plain = {(r.domain, r.url): r.start_s for r in cp.fetch_plan(todo, 0.1).collect()}
    assert plain[("a", "u2")] == 4.0 and plain[(None, "n")] == 0.0


def test_violations_with_own_gaps_and_null_domain(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(d, i, t0 + timedelta(seconds=s)) for i, (d, s) in enumerate([("a", 0), ("a", 5), ("a", 20), ("b", 0), ("b", 5), (None, 0), (None, 3)])]
    log = spark.createDataFrame(rows, "domain string, event_id long, ts timestamp")
    gaps = spark.createDataFrame([("a", 16.0), ("b", 1.0)], "domain string, gap double")
    got = sorted((r.domain or "", r.event_id, r.gap_s) for r in cp.politeness_violations(log, 4.0, gaps=gaps).collect())
    assert got == [("", 6, 3.0), ("a", 1, 5.0), ("a", 2, 15.0)]


def test_report_lists_a_ranker_without_results(spark):
    q = spark.createDataFrame([(1,), (2,)], "qid long")
    ranked = spark.createDataFrame([("bm25", 1, 1, 5, 2.0), ("bm25", 1, 2, 6, 1.0)], "ranker string, qid long, rank long, doc_id long, score double")
    got = {r.ranker: r for r in rp.run_report(q, ranked, ("bm25", "none")).collect()}
    assert (got["bm25"].with_results, got["bm25"].total_results, got["bm25"].avg_score) == (1, 2, 1.5)
    assert (got["none"].queries, got["none"].with_results, got["none"].total_results, got["none"].min_score) == (2, 0, 0, None)


def test_success_and_summary(spark):
    f = spark.createDataFrame([(1, "ok"), (2, "error"), (3, None)], "id long, status string")
    assert [r.id for r in successful(f).collect()] == [1]
    pages = spark.createDataFrame([(1, "http://h/", "<title>T</title><p>a b</p>")], "page_id long, url string, html string")
    import json
    row = json.loads(summary_json(pages).first().json)
    assert (row["title"], row["url"], row["text"]) == ("T", "http://h/", "T a b") and datetime.fromisoformat(row["timestamp"])
