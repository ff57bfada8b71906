"""State that streams keep between runs: politeness clock, index segments, frontier, progress."""

import random

import pytest
from pyspark.sql import functions as F

from trawl.streaming import frontier, politeness, progress, runner, segments, store


def test_batches_replace_themselves_and_fold(spark, tmp_dir):
    rows = lambda *xs: spark.createDataFrame([(x,) for x in xs], "v long")
    read = lambda before=None: sorted((r.v, r.batch) for r in store.read_batches(spark, tmp_dir + "/t", "v long, batch long", before).collect())
    assert read() == []
    for n, v in ((0, 1), (1, 2), (1, 3), (2, 4)):
        store.write_batch(rows(v), tmp_dir + "/t", n)
    assert read() == [(1, 0), (3, 1), (4, 2)] and read(2) == [(1, 0), (3, 1)]
    store.write_batch(rows(10, 11), tmp_dir + "/t", 1, replaces_earlier=True)
    assert read() == [(4, 2), (10, 1), (11, 1)] and read(1) == [(1, 0)]


def test_politeness_over_rounds(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(politeness, "FOLD_BATCHES", 3)
    r, clock, last, want = random.Random(2), politeness.DomainClock(tmp_dir + "/c", 0.5), {}, {}
    delays = {"a": 2.0, "b": None, "c": 0.0, None: 1.0}
    for n in range(7):
        now = 3.0 * n
        rows = [(d, f"u{n}-{i}", f"{i:03}", delays[d]) for i, d in enumerate(r.choice(list(delays)) for _ in range(r.randint(0, 9)))]
        allowed = spark.createDataFrame(rows, "domain string, url string, prio string, delay double")
        for _ in range(1 + n % 2):  # a retried batch changes nothing
            clock.add(allowed, n, now)
        for d, u, _, delay in sorted(rows, key=lambda x: x[2]):
            at = max(now, last.get(d, -100) + (delay or 0.5))
            last[d] = want[u] = at
    assert {x.url: x.at_s for x in clock.plan(spark).collect()} == pytest.approx(want)
    assert {x.url for x in clock.due(spark, 5.0, 9.0).collect()} == {u for u, t in want.items() if 5 < t <= 9}
    asked = {x.domain for x in clock.last_requests(spark).collect()}
    assert asked <= set(last) and asked >= {d for d, t in last.items() if t + (delays[d] or 0.5) > 18.0}


class Model:
    """Documents and postings as dicts, the latest version of each."""

    def __init__(self):
        self.docs, self.pairs, self.lengths = {}, {}, {}

    def add(self, docs):
        for i, words in docs.items():
            self.docs[i], self.lengths[i] = words, len(words)
            self.pairs |= {(w, i): words.count(w) for w in words}

    def postings(self, rule):
        if rule == "pairs":
            return {(w, i): (n, self.lengths[i]) for (w, i), n in self.pairs.items()}
        return {(w, i): (words.count(w), len(words)) for i, words in self.docs.items() for w in words}


@pytest.mark.parametrize("rule", ["pairs", "documents"])
def test_segments_against_a_model(spark, tmp_dir, rule):
    r, model = random.Random(len(rule)), Model()
    kept = segments.Segments(tmp_dir + "/s", buckets=3, fan_in=2, rule=rule, stopwords=None)
    for n in range(7):
        docs = {r.randint(0, 8): [f"w{r.randint(0, 12)}" for _ in range(r.randint(0, 5))] for _ in range(4)}
        gone = [i for i in list(model.docs) if r.random() < 0.3] if rule == "documents" and n % 3 == 2 else None
        for _ in range(1 + n % 2):
            if gone is not None:
                kept.remove(spark.createDataFrame([(i,) for i in gone], "doc_id long"), n)
            else:
                kept.add(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string"), n, title_col=None)
        if gone is None:
            model.add(docs)
        for i in gone or ():
            model.docs.pop(i)
    index = kept.index(spark)
    assert {(x.term, x.doc_id): (x.tf, x.dl) for x in index.postings.collect()} == model.postings(rule)
    lengths = {i: len(w) for i, w in model.docs.items()} if rule == "documents" else model.lengths
    assert {x.doc_id: x.dl for x in index.doc_lengths.collect()} == lengths


def test_a_merge_touches_full_buckets_only(spark, tmp_dir):
    kept = segments.Segments(tmp_dir + "/s", buckets=16, fan_in=3, stopwords=None)
    add = lambda n, *texts: kept.add(spark.createDataFrame([(100 * n + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), n, title_col=None)
    add(0, "red apple", "car green tart pie")
    add(1, "red")
    before = {(x.segment, x.tb) for x in kept.manifest(spark)}
    add(2, "red")
    live = {(x.segment, x.tb, x.tier) for x in kept.manifest(spark)}
    merged = {tb for s, tb, tier in live if tier == 1}
    assert merged and {(s, tb) for s, tb, tier in live if tier == 0} == {(s, tb) for s, tb in before if tb not in merged} != set()
    folders = {int(p.split("tb=")[1].split("/")[0]) for p in spark.read.parquet(f"{kept.path}/segments/m2-1").inputFiles()}
    assert folders == merged
    assert {(x.term, x.doc_id) for x in kept.index(spark).postings.collect()} == {
        ("red", 0), ("apple", 0), ("car", 1), ("green", 1), ("tart", 1), ("pie", 1), ("red", 100), ("red", 200)}


def test_frontier_over_rounds(spark, tmp_dir):
    import hashlib
    urls = lambda xs: spark.createDataFrame([(x,) for x in xs], "url string")
    md5 = lambda u: hashlib.md5(u.encode()).hexdigest()
    r, kept, met, waiting = random.Random(4), frontier.Frontier(tmp_dir + "/f", 64), set(), set()
    for n in range(4):
        links = [f"u{r.randint(0, 60)}" for _ in range(40)]
        fetched = [f"u{r.randint(0, 60)}" for _ in range(5)]
        new = set(links) - met - set(fetched)
        assert {x.url for x in kept.add(urls(links), n, visited=urls(fetched)).collect()} == new
        met |= set(links) | set(fetched)
        waiting = (waiting | new) - set(fetched)
        assert {x.url for x in kept.waiting(spark).collect()} == waiting
        for _ in range(2):  # taken again after a failure: the same URLs
            assert [x.url for x in kept.take(n, 7).orderBy("prio").collect()] == sorted(waiting, key=md5)[:7]
        waiting -= set(sorted(waiting, key=md5)[:7])


def test_closed_windows_and_late_rows(spark, tmp_dir):
    kept, src = progress.Progress(tmp_dir + "/p", "1 hour", "1 hour"), tmp_dir + "/src"
    hours = [[0, 0, 1, 2, 5], [1, 4, 5, 9], [0, 8, 9, 12], [20]]
    states = []
    for batch in hours:
        rows = spark.createDataFrame([(h,) for h in batch], "h int").selectExpr("timestamp'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, h) AS ts")
        rows.coalesce(1).write.mode("append").parquet(src)
        states.append([s["numRowsTotal"] for p in kept.run(runner.file_stream(spark, src)) for s in p["stateOperators"]][-1])
    closed = {x.window_start.hour: x.fetches for x in kept.windows(spark).collect()}
    assert closed == {0: 2, 1: 1, 2: 1, 4: 1, 5: 2, 8: 1, 9: 2, 12: 1}
    assert sorted(x.window_start.hour for x in kept.late(spark).collect()) == [0, 1]
    assert states[-1] == 1 and max(states) <= 3
    assert kept.late(spark).agg(F.count("*")).first()[0] == 2
