"""Reader cases restated for the Spark sources (thread and close cases do not apply)."""

import json
import os

import pytest

from trawl.sources import corpus as src


def _write(path, lines):
    with open(path, "w") as f:
        f.write("".join(lines))


def test_records_in_two_files(spark, tmp_dir):
    for name, records in (("a", [{"id": 31, "text": "north wind"}, {"id": "0040", "title": "Tide", "text": ""}]),
                          ("b", [{"id": 7, "text": "low\nwater", "extra": True}])):
        _write(os.path.join(tmp_dir, f"{name}.jsonl"), [json.dumps(r) + "\n" for r in records])
    rows = src.with_defaults(src.read_corpus(spark, tmp_dir)).collect()
    assert sorted((r.doc_id, r.title, r.text) for r in rows) == [(7, "", "low\nwater"), (31, "", "north wind"), (40, "Tide", "")]


def test_empty_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "empty.jsonl")
    _write(p, [])
    assert src.read_corpus(spark, p).count() == 0


def test_defaults_and_numeric_string_ids(spark, tmp_dir):
    p = os.path.join(tmp_dir, "d.jsonl")
    _write(p, ['{"id": "0000012", "title": "T", "text": "x"}\n', '{"text": "no id"}\n', "\n",
               '{"id": 5, "title": null}\n'])
    rows = src.with_defaults(src.read_corpus(spark, p)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.title, r.text) for r in rows] == [(-1, "", "no id"), (5, "", ""), (12, "T", "x")]


def test_malformed_line_fails(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.jsonl")
    _write(p, ['{"id": 1, "text": "ok"}\n', "{not json\n"])
    with pytest.raises(Exception):
        src.read_corpus(spark, p).collect()


def test_query_file(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.txt")
    _write(p, ["  red apple \n", "\n", "zebra\n", "   \n", "red apple\n", "\tlast"])
    rows = src.read_queries(spark, p).orderBy("qid").collect()
    assert [r.query for r in rows] == ["red apple", "zebra", "red apple", "last"]
    assert [r.qid for r in rows] == [0, 2, 4, 5]


def test_seed_file_reads_past_blank_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "seeds.txt")
    _write(p, ["http://a.example/\n", "\n", "http://b.example/\n"])
    assert sorted(r.url for r in src.read_seeds(spark, p).collect()) == ["http://a.example/", "http://b.example/"]


def test_dir_size(spark, tmp_dir):
    for name, n in (("a.bin", 1000), ("b.bin", 24)):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"x" * n)
    r = src.dir_size_bytes(spark, tmp_dir).collect()[0]
    assert (r.files, r.bytes) == (2, 1024)


def test_page_store_rotation(spark, tmp_dir):
    from trawl.sources import page_store
    pages = spark.range(0, 250).selectExpr("id as page_id", "concat('http://h.example/', id) as url",
                                           "'<p>x</p>' as html")
    out = os.path.join(tmp_dir, "store")
    page_store.write_pages(page_store.with_response(pages, 404, {"Server": "x"}), out, per_file=40)
    assert page_store.read_pages(spark, out).filter("status = 404 and headers['Server'] = 'x'").count() == 250
    counts = [r.records for r in page_store.records_per_file(spark, out).collect()]
    assert sum(counts) == 250 and max(counts) <= 40
    assert all(f.endswith(".json.gz") for f in os.listdir(out) if f.startswith("part-"))


def test_results_json(spark):
    from trawl.operators.index import build_index
    from trawl.operators.rank import results_json, results_per_query, search
    corpus = spark.createDataFrame([(1, "red apple"), (2, "red red car")], "doc_id long, text string")
    idx = build_index(corpus, stopwords=None, title_col=None)
    q = spark.createDataFrame([(0, "red"), (1, "zebra")], "qid long, query string")
    out = {r.qid: json.loads(r.json) for r in results_json(results_per_query(q, search(q, idx))).collect()}
    assert out[1] == {"Query": "zebra", "Results": []}
    assert out[0]["Query"] == "red" and [x["ID"] for x in out[0]["Results"]] == ["0000002", "0000001"]
    assert all(isinstance(x["Score"], float) for x in out[0]["Results"])


def test_repeated_id_later_record_wins(spark, tmp_dir):
    from trawl.operators.index import build_index
    p = os.path.join(tmp_dir, "dup.jsonl")
    _write(p, ['{"id": 1, "text": "red apple"}\n', '{"id": 2, "text": "green pie"}\n',
               '{"id": 1, "text": "blue car car"}\n'])
    corpus = src.with_defaults(src.read_corpus(spark, p))
    idx = build_index(corpus, stopwords=None)
    post = {(r.term, r.doc_id): r.tf for r in idx.postings.collect()}
    assert post == {("blue", 1): 1, ("car", 1): 2, ("green", 2): 1, ("pie", 2): 1}
    assert {r.doc_id: r.dl for r in idx.doc_lengths.collect()} == {1: 3, 2: 2}
