"""URL de-duplication whose state ends: what it forgets, the visited table knows."""

from pyspark.sql import functions as F

from trawl.streaming import dedup, runner


def page(n, ts, links):
    return (n, f"http://h{n}.org/", "".join(f'<a href="{x}">x</a>' for x in links), ts)


def test_every_url_once_over_runs_and_state_expires(spark, tmp_dir):
    src, path = tmp_dir + "/src", tmp_dir + "/visited"
    runs = []
    for k in range(4):
        rows = [page(100 * k + i, 1_700_000_000 + 86_400 * k + i, [f"http://x.org/{j}" for j in (i, i + 1, 30 * k + i)]) for i in range(30)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string, ts long").withColumn("ts", F.timestamp_seconds("ts"))
        df.coalesce(1).write.mode("append").parquet(src)
        reports = dedup.first_seen(runner.file_stream(spark, src), path, "1 hour", "ts", bits=64)
        runs.append((len({u for r in rows for u in r[2].split('"')[1::2]}), [s["numRowsTotal"] for p in reports for s in p["stateOperators"]][-1]))
    urls = [r.url for r in dedup.Visited(path, 64).urls(spark).collect()]
    assert len(urls) == len(set(urls)) == 120
    # The state holds one day's URLs, not those of all days.
    assert all(state <= met for met, state in runs), runs


def test_a_retried_batch_is_judged_alike(spark, tmp_dir):
    v = dedup.Visited(tmp_dir + "/v", 64)  # so few bits that most URLs share one
    batch = lambda *xs: spark.createDataFrame([(x,) for x in xs], "url string")
    new = lambda df: sorted(r.url for r in df.collect())
    assert new(v.add(batch("a", "b", "a"), 0)) == ["a", "b"]
    many = [f"u{i}" for i in range(80)]
    for _ in range(2):
        assert new(v.add(batch("a", *many), 1)) == sorted(many)
    assert new(v.add(batch("b", "u3", "c"), 2)) == ["c"]
    assert new(v.add(batch(), 3)) == []
    assert v.urls(spark).count() == 83
    assert v.bitmap(spark).count() == 1


def test_arrival_time_leaves_no_page_out(spark, tmp_dir):
    src = tmp_dir + "/src"
    spark.createDataFrame([page(1, 0, ["http://x.org/a"])], "page_id long, url string, html string, ts long").write.parquet(src)
    dedup.first_seen(runner.file_stream(spark, src), tmp_dir + "/v", "0 seconds")
    assert [r.url for r in dedup.Visited(tmp_dir + "/v").urls(spark).collect()] == ["http://x.org/a"]
