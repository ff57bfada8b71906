"""Registered plans: one callable per operator key, each ``(spark, sf_dir) -> DataFrame``.

Every plan reads the whole test tables (or tables Spark derives from them).
Columns are aliased to the names the oracle SQL uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators import index as ix
from trawl.operators import rank as rk
from trawl.plans import inputs as inp

Plan = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Plan] = {}


def plan(name: str) -> Callable[[Plan], Plan]:
    def deco(fn: Plan) -> Plan:
        REGISTRY[name] = fn
        return fn
    return deco


def _index(spark: SparkSession, sf_dir: str) -> ix.Index:
    """Index plan over the documents, whose ids are unique."""
    return ix.build_index(inp.corpus(spark, sf_dir), unique_ids=True)


def _ready(spark: SparkSession, sf_dir: str, stem: bool = False) -> ix.Index:
    """The same with its postings stored once, for plans that use them several times."""
    return ix.build_index(inp.corpus(spark, sf_dir), stem=stem, unique_ids=True).tokenized_once()


def _opened(spark: SparkSession, sf_dir: str) -> ix.Index:
    """The same written as posting blocks and opened again."""
    from trawl.session import scratch_path
    path = scratch_path(spark, "index")
    _index(spark, sf_dir).write(path, layout="blocks")
    return ix.Index.read(spark, path)


def _rounded(ranked: DataFrame) -> DataFrame:
    return ranked.select("qid", "rank", "doc_id", F.round("score", 4).alias("score"))


# ---------------------------------------------------------------- index build
@plan("tokens")
def tokens_all(spark, sf_dir):
    """Every token occurrence, no stop words removed."""
    return ix.tokens(inp.corpus(spark, sf_dir), stopwords=None)


@plan("tokens_stop_filtered")
def tokens_stop_filtered(spark, sf_dir):
    """Token occurrences after stop-word removal."""
    return ix.tokens(inp.corpus(spark, sf_dir))


@plan("postings")
def postings(spark, sf_dir):
    """(term, doc_id, tf)."""
    return _index(spark, sf_dir).postings.select("term", "doc_id", "tf")


@plan("doc_lengths")
def doc_lengths(spark, sf_dir):
    """Length after stop words, empty documents kept."""
    return _index(spark, sf_dir).doc_lengths


@plan("lexicon")
def lexicon(spark, sf_dir):
    """I4: (term, df)."""
    return _index(spark, sf_dir).lexicon


@plan("collection_stats")
def collection_stats(spark, sf_dir):
    """N and average length."""
    return _index(spark, sf_dir).stats.select("n", F.round("avgdl", 6).alias("avgdl"))


# ---------------------------------------------------------------- ranking
@plan("bm25_topk")
def bm25_topk(spark, sf_dir):
    """R1 + R3 + R4: exact BM25 top-10 for every benchmark query."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "bm25", inp.TOP_K))


@plan("bm25_scores")
def bm25_scores(spark, sf_dir):
    """Single-term BM25 score of every posting of every query term."""
    c = rk.term_contributions(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "bm25")
    return c.select("qid", "term", "doc_id", F.round("s", 6).alias("s"))


@plan("tfidf_scores")
def tfidf_scores(spark, sf_dir):
    """R2: single-term TF-IDF score of every posting of every query term."""
    c = rk.term_contributions(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "tfidf")
    return c.select("qid", "term", "doc_id", F.round("s", 6).alias("s"))


@plan("tfidf_topk")
def tfidf_topk(spark, sf_dir):
    """R2 + R4: exact TF-IDF top-10."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "tfidf", inp.TOP_K))


@plan("bm25_topk_floor")
def bm25_topk_floor(spark, sf_dir):
    """BM25 with the reference's score floor."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "bm25", inp.TOP_K,
                              mode="floor"))


@plan("tfidf_topk_floor")
def tfidf_topk_floor(spark, sf_dir):
    """TF-IDF with the reference's score floor."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "tfidf", inp.TOP_K,
                              mode="floor"))


@plan("bm25_topk_all_terms")
def bm25_topk_all_terms(spark, sf_dir):
    """Only documents holding every distinct query term."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _opened(spark, sf_dir), "bm25", inp.TOP_K, match="all"))


@plan("bm25_all_terms_short")
def bm25_all_terms_short(spark, sf_dir):
    """R7 with many answers: the first two and the first four words of every passage."""
    q = inp.bench_queries(spark, sf_dir)
    two, four = (q.select((F.col("qid") * 10 + n).alias("qid"), F.substring_index("query", " ", n).alias("query")) for n in (2, 4))
    return _rounded(rk.search(two.unionByName(four), _opened(spark, sf_dir), "bm25", inp.TOP_K, match="all"))


@plan("bm25_topk_pruned")
def bm25_topk_pruned(spark, sf_dir):
    """Upper-bound candidate cut over the posting blocks of a written index; must equal bm25_topk."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _opened(spark, sf_dir), "bm25", inp.TOP_K, prune=True))


@plan("custom_ranker")
def custom_ranker(spark, sf_dir):
    """A user ranker (BM25 with k1 = 1.2, b = 0.5) evaluated inside Catalyst."""
    from trawl.functions.scoring import bm25_with
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), bm25_with(1.2, 0.5),
                              inp.TOP_K))


@plan("tfidf_zero_idf")
def tfidf_zero_idf(spark, sf_dir):
    """Over the documents that contain the most common term, that term has
    idf 0, so a query of that term alone returns nothing."""
    from trawl.operators.distribute import broadcast_if_small
    corpus = inp.corpus(spark, sf_dir)
    full = _ready(spark, sf_dir)
    top = full.lexicon.orderBy(F.col("df").desc(), F.col("term")).limit(1)
    docs = full.postings.join(F.broadcast(top.select("term")), "term", "left_semi").select("doc_id")  # one term
    sub = corpus.join(broadcast_if_small(rk._written(docs, "docs")), "doc_id", "left_semi")
    queries = inp.bench_queries(spark, sf_dir).unionByName(
        top.select(F.lit(-1).cast("long").alias("qid"), F.col("term").alias("query")))
    return _rounded(rk.search(queries, ix.build_index(sub, unique_ids=True).tokenized_once(), "tfidf", inp.TOP_K))


@plan("term_upper_bounds")
def term_upper_bounds(spark, sf_dir):
    """Largest single-term BM25 score per known query term."""
    ub = rk.term_upper_bounds(inp.bench_queries(spark, sf_dir), _opened(spark, sf_dir), "bm25")
    return ub.select("qid", "term", "qtf", F.round("ub", 4).alias("ub"))


@plan("query_term_weights")
def query_term_weights(spark, sf_dir):
    """Query tokens with their repeat count."""
    return rk.query_terms(inp.bench_queries(spark, sf_dir))


@plan("query_known_terms")
def query_known_terms(spark, sf_dir):
    """Query terms present in the lexicon, with df."""
    from trawl.operators.distribute import broadcast_if_small
    qt = rk.query_terms(inp.bench_queries(spark, sf_dir))
    return (_ready(spark, sf_dir).lexicon.join(broadcast_if_small(qt, rk.MAX_QUERY_TERM_ROWS), "term")
            .select("qid", "term", "qtf", "df"))


@plan("postings_lookup")
def postings_lookup(spark, sf_dir):
    """Postings of the query vocabulary only."""
    from trawl.sources.index_store import lookup
    qt = rk.query_terms(inp.bench_queries(spark, sf_dir))
    return lookup(_ready(spark, sf_dir), qt.select("term")).select("term", "doc_id", "tf")


@plan("results_formatted")
def results_formatted(spark, sf_dir):
    """7-digit ids and 4-decimal scores."""
    return rk.format_results(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir), "bm25",
                                       inp.TOP_K))


def _all_queries(spark, sf_dir):
    return inp.bench_queries(spark, sf_dir).unionByName(inp.extra_queries(spark))


@plan("results_json")
def results_json(spark, sf_dir):
    """S9 + J5: one JSON line per query, read back: ids and scores in rank order."""
    q = _all_queries(spark, sf_dir)
    lines = rk.results_json(rk.results_per_query(q, rk.search(q, _ready(spark, sf_dir), "bm25", inp.TOP_K)))
    back = lines.select("qid", F.from_json(
        "json", "Query string, Results array<struct<ID:string,Score:double>>").alias("j"))
    return back.select(
        "qid", F.col("j.Query").alias("query"),
        F.array_join(F.transform("j.Results", lambda r: r["ID"]), ",").alias("ids"),
        F.array_join(F.transform("j.Results", lambda r: F.format_string("%.4f", r["Score"])), ",").alias("scores"))


@plan("queries_without_hits")
def queries_without_hits(spark, sf_dir):
    """Queries with stop words only, unknown or empty text still give a row."""
    q = _all_queries(spark, sf_dir)
    res = rk.results_per_query(q, rk.search(q, _ready(spark, sf_dir), "bm25", inp.TOP_K))
    return res.select("qid", F.size("Results").cast("long").alias("n_results"))


# ---------------------------------------------------------------- sources and sinks
@plan("read_corpus_jsonl")
def read_corpus_jsonl(spark, sf_dir):
    """S1 + S2: the documents written as a JSONL corpus (id as a zero-padded
    string), read back with defaults applied."""
    from trawl.session import scratch_path
    from trawl.sources import corpus as src
    path = scratch_path(spark, "corpus-jsonl")
    docs = inp.table(spark, sf_dir, "documents")
    docs.select(F.format_string("%07d", "doc_id").alias("id"), F.lit("").alias("title"), "text").write.json(path)
    back = src.with_defaults(src.read_corpus(spark, path))
    return back.select("doc_id", "title", F.md5("text").alias("text_md5"))


@plan("corpus_defaults")
def corpus_defaults(spark, sf_dir):
    """Missing id -> -1, missing title / text -> ''."""
    from trawl.sources import corpus as src
    d = inp.table(spark, sf_dir, "documents")
    raw = d.select(
        F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.format_string("%07d", "doc_id")).alias("id"),
        F.when(F.col("lang") == "es", F.lit(None)).otherwise(F.col("source")).alias("title"),
        F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("text")).alias("text"))
    return src.with_defaults(raw).select("doc_id", "title", F.md5("text").alias("text_md5"))


@plan("queries_from_text")
def queries_from_text(spark, sf_dir):
    """S3: a query file (padded lines in item order, a blank line after each) read back."""
    from trawl.session import scratch_path
    from trawl.sources import corpus as src
    path = scratch_path(spark, "queries-txt")
    padded = F.concat(F.lit("  "), "query", F.lit(" \t\n   "))
    # One file, as a query file is: its size is that of the query set.
    (inp.bench_queries(spark, sf_dir).select("qid", padded.alias("value")).coalesce(1)
     .sortWithinPartitions("qid").select("value").write.text(path))
    return src.read_queries(spark, path).select("qid", "query")


@plan("seeds_from_text")
def seeds_from_text(spark, sf_dir):
    """The page URLs as a seed list with blank lines, read back."""
    from trawl.session import scratch_path
    from trawl.sources import corpus as src
    path = scratch_path(spark, "seeds-txt")
    inp.pages(spark, sf_dir).select(F.concat(F.lit(" "), "url", F.lit("\n\n")).alias("value")).write.text(path)
    return src.read_seeds(spark, path)


@plan("corpus_sample")
def corpus_sample(spark, sf_dir):
    """The first three records by id, whole."""
    return inp.table(spark, sf_dir, "documents").orderBy("doc_id").limit(3).select("doc_id", "text")


@plan("index_nested")
def index_nested(spark, sf_dir):
    """Postings per term as a doc-ordered map, flattened to 'doc:tf,...'."""
    return ix.flatten_postings(ix.nested_postings(_index(spark, sf_dir).postings))


def _whole_index(index: ix.Index) -> DataFrame:
    """Every table of an index as (part, term, doc_id, v, w); '', -1 and 0 where a table has no such column."""
    no_doc = F.lit(-1).cast("long")
    parts = [
        index.postings.select(F.lit("postings").alias("part"), "term", "doc_id", F.col("tf").alias("v"),
                              F.col("dl").cast("double").alias("w")),
        index.lexicon.select(F.lit("lexicon"), "term", no_doc, "df", F.lit(0.0)),
        index.doc_lengths.select(F.lit("doc_lengths"), F.lit(""), "doc_id", "dl", F.lit(0.0)),
        index.stats.select(F.lit("stats"), F.lit(""), no_doc, "n", F.round("avgdl", 6)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@plan("index_roundtrip")
def index_roundtrip(spark, sf_dir):
    """S6 + S7: write the index, open it again: postings, lexicon, lengths, statistics."""
    from trawl.session import scratch_path
    path = scratch_path(spark, "index")
    _index(spark, sf_dir).write(path)
    return _whole_index(ix.Index.read(spark, path))


@plan("index_overwrite")
def index_overwrite(spark, sf_dir):
    """An index of the German documents written over one of all documents."""
    from trawl.session import scratch_path
    path = scratch_path(spark, "index")
    _index(spark, sf_dir).write(path, term_buckets=8)
    german = inp.table(spark, sf_dir, "documents").filter(F.col("lang") == "de").select("doc_id", "text")
    ix.build_index(german, unique_ids=True).write(path, term_buckets=4)
    return _whole_index(ix.Index.read(spark, path))


@plan("index_repeated_ids")
def index_repeated_ids(spark, sf_dir):
    """Ids folded with pmod(doc_id, 97): the last record of an id is indexed."""
    d = inp.table(spark, sf_dir, "documents").select(
        F.pmod("doc_id", F.lit(97)).alias("doc_id"), F.col("doc_id").alias("seq"), "text")
    return _whole_index(ix.build_index(d, last_wins_order=["seq"]).tokenized_once())


@plan("index_dir_size")
def index_dir_size(spark, sf_dir):
    """Bytes below an index' postings folder, against the sizes that the scan of
    its files reports."""
    from trawl.session import scratch_path
    from trawl.sources import corpus as src
    path = scratch_path(spark, "index")
    _index(spark, sf_dir).write(path)
    files = (spark.read.parquet(f"{path}/postings").select("_metadata.file_path", "_metadata.file_size").distinct()
             .agg(F.sum("file_size").alias("listed"), F.count("*").alias("n")))
    marker = 1  # the writer's empty _SUCCESS file
    both = files.crossJoin(F.broadcast(src.dir_size_bytes(spark, f"{path}/postings")))  # one row each
    return both.select(((F.col("bytes") == F.col("listed")) & F.col("files").between(F.col("n"), F.col("n") + marker)).alias("same"))


@plan("page_store_rotation")
def page_store_rotation(spark, sf_dir):
    """Gzip JSON page store with status and headers, at most 100 records per file."""
    from trawl.session import scratch_path
    from trawl.sources import page_store
    path = scratch_path(spark, "pages")
    page_store.write_pages(page_store.with_response(inp.pages(spark, sf_dir)), path, per_file=100)
    store = page_store.read_pages(spark, path)
    sizes = page_store.records_per_file(spark, path).agg(
        F.max(F.col("records") <= 100).alias("_any"), F.min(F.col("records") <= 100).alias("within"), F.sum("records").alias("records"))
    kinds = store.agg(F.count_if((F.col("status") == 200) & (F.col("headers")["Content-Type"] == "text/html")).alias("answered"))
    return sizes.crossJoin(F.broadcast(kinds)).select("within", "records", "answered")  # one row each


# ---------------------------------------------------------------- merge, last wins, profiles
# Extra stop words used by the second partial index in the merge
# plan, so that pairs present only in the first part must survive the merge.
MERGE_EXTRA_STOP = ("de", "der", "la", "die", "und", "que", "le", "et", "en", "des")


@plan("merge_partials")
def merge_partials(spark, sf_dir):
    """Two partials over overlapping id ranges; the later one (doubled text, more
    stop words) wins per (term, doc), and its length holds for the whole document."""
    from trawl.operators.index import DEFAULT_STOPWORDS
    from trawl.session import scratch_path
    c = inp.corpus(spark, sf_dir)
    top = c.agg(F.max("doc_id")).first()[0] or 0
    p0 = ix.postings_with_lengths(ix.doc_terms(c.filter(F.col("doc_id") <= top * 2 / 3)))
    doubled = c.filter(F.col("doc_id") >= top / 3).withColumn("text", F.concat_ws(" ", "text", "text"))
    p1 = ix.postings_with_lengths(ix.doc_terms(doubled, stopwords=tuple(DEFAULT_STOPWORDS) + MERGE_EXTRA_STOP))
    path = scratch_path(spark, "partials")
    p0.withColumn("part_no", F.lit(0)).unionByName(p1.withColumn("part_no", F.lit(1))).write.parquet(path)
    parts = spark.read.parquet(path)
    return ix.index_from_combined(ix.merge_partials(parts)).postings.select("term", "doc_id", "tf", "dl")


@plan("corpus_last_wins")
def corpus_last_wins(spark, sf_dir):
    """Ids folded with pmod(doc_id, 97); the record with the largest
    original id (the later line) wins."""
    d = inp.table(spark, sf_dir, "documents").select(
        F.pmod("doc_id", F.lit(97)).alias("id"), F.col("doc_id").alias("seq"), "source", "n_chars", "text")
    last = ix.last_record_per_id(d, "id", ["seq"])
    return last.select("id", "seq", "source", "n_chars", F.md5("text").alias("text_md5"))


@plan("index_stats")
def index_stats(spark, sf_dir):
    """Number of lists, total postings, average list size."""
    return ix.index_stats(_index(spark, sf_dir))


@plan("lexicon_profile")
def lexicon_profile(spark, sf_dir):
    """I8: df distribution of the lexicon."""
    return ix.lexicon_profile(_index(spark, sf_dir).lexicon)


@plan("corpus_profile")
def corpus_profile(spark, sf_dir):
    """Documents and bytes of text."""
    return ix.corpus_profile(inp.table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- reports
def _both_rankers(spark, sf_dir):
    """Both rankers from one scan (``search_many``): (ranker, qid, rank, doc_id, score)."""
    q = inp.bench_queries(spark, sf_dir)
    both = rk.search_many(q, _ready(spark, sf_dir), {"bm25": "bm25", "tfidf": "tfidf"}, inp.TOP_K)
    return q, both.select("ranker", "qid", "rank", "doc_id", F.round("score", 4).alias("score"))


@plan("run_report")
def run_report(spark, sf_dir):
    """Per ranker queries, hits, results and score range; "none" finds nothing."""
    from trawl.operators import report as rp
    q, both = _both_rankers(spark, sf_dir)
    return rp.run_report(q, both, ("bm25", "tfidf", "none"))


@plan("ranker_comparison")
def ranker_comparison(spark, sf_dir):
    """Average score per ranker side by side."""
    from trawl.operators import report as rp
    return rp.compare_rankers(_both_rankers(spark, sf_dir)[1])


@plan("ranker_overlap")
def ranker_overlap(spark, sf_dir):
    """Shared top-10 documents per query, every query."""
    from trawl.operators import report as rp
    q, both = _both_rankers(spark, sf_dir)
    return rp.overlap(q, both)


@plan("ranker_shared_docs")
def ranker_shared_docs(spark, sf_dir):
    """The shared ids per query."""
    from trawl.operators import report as rp
    return rp.shared_docs(_both_rankers(spark, sf_dir)[1])


@plan("ranker_best")
def ranker_best(spark, sf_dir):
    """E5: best document per query and ranker, ties listed."""
    from trawl.operators import report as rp
    return rp.best_docs(_both_rankers(spark, sf_dir)[1])


# ---------------------------------------------------------------- pages and links
@plan("page_domain")
def page_domain(spark, sf_dir):
    """C1 + P6: host of every page URL."""
    from trawl.operators import pages as pg
    return pg.page_domain(inp.pages(spark, sf_dir))


@plan("page_text")
def page_text(spark, sf_dir):
    """C2 + C3: visible text."""
    from trawl.operators import pages as pg
    return pg.page_text(inp.pages(spark, sf_dir)).select("page_id", "text")


@plan("page_title")
def page_title(spark, sf_dir):
    """C4: trimmed title, '' when absent."""
    from trawl.operators import pages as pg
    return pg.page_title(inp.pages(spark, sf_dir))


@plan("page_links")
def page_links(spark, sf_dir):
    """Distinct raw hrefs per page."""
    from trawl.operators import pages as pg
    return pg.page_links(inp.pages(spark, sf_dir))


@plan("link_edges")
def link_edges(spark, sf_dir):
    """C5 + P4: resolved, http-only, distinct edges."""
    from trawl.operators import pages as pg
    return pg.link_edges(inp.pages(spark, sf_dir)).select("page_id", "dst_url")


@plan("page_summary")
def page_summary(spark, sf_dir):
    """Title, URL and the first 20 words of the first 1000 characters."""
    from trawl.operators import pages as pg
    return pg.page_summary(inp.pages(spark, sf_dir))


@plan("pages_bm25_topk")
def pages_bm25_topk(spark, sf_dir):
    """Index title + text of the pages, answer the benchmark queries."""
    from trawl.operators import pages as pg
    index = ix.build_index(pg.pages_corpus(inp.pages(spark, sf_dir)), unique_ids=True).tokenized_once()
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), index, "bm25", inp.TOP_K))


# ---------------------------------------------------------------- crawl planning
# Robots rule sets assigned to a domain by length(domain) % 4.
# Bucket 0 has no row (robots file unavailable: the domain is skipped); bucket 1
# has a file with an empty Disallow line and delay 0 (default delay applies); bucket 2
# allows a prefix before disallowing an overlapping shorter one, and bars another agent
# from everything; bucket 3 has rules for everyone that its own for this agent replace.
CRAWL_AGENT = "trawlbot"
ROBOTS_TEMPLATE: tuple[tuple[int, str | None, int, bool | None, str | None, float], ...] = (
    (1, "*", 1, False, "", 0.0),
    (2, "*", 1, True, "/en/1", 2.0),
    (2, None, 2, False, "/en", 2.0),
    (2, "otherbot", 1, False, "/", 9.0),
    (3, "*", 1, False, "/", 7.0),
    (3, "TrawlBot", 1, False, "/fr", 0.5),
    (3, "trawlbot", 2, False, "/es", 0.5),
)
# A domain of length l was last asked l % 3 seconds ago, none if 0.
LAST_REQUEST_MOD = 3
VIOLATION_GAP_S = 600.0   # minimum gap between two requests of one user in the log
BUDGET_PAGES = 1000       # page budget for the crawl_budget plan


# Seconds between the rounds of the politeness stream.
ROUND_S = 6.0


def _crawl_inputs(spark, sf_dir):
    from trawl.functions import html as H
    from trawl.operators import pages as pg
    p = inp.pages(spark, sf_dir)
    seeds = p.select(F.concat(F.regexp_extract("url", rf"^({H.SCHEME}://[^/?#]*)", 1), F.lit("/")).alias("url"))
    return p, seeds, pg.link_edges(p)


def _robots_rules(spark, pages):
    from trawl.functions import html as H
    from trawl.operators.crawlplan import RULES_SCHEMA
    t = spark.createDataFrame(list(ROBOTS_TEMPLATE), "bucket int, agent string, seq int, allow boolean, prefix string, delay double")
    doms = pages.filter(H.has_host(F.col("url"))).select(H.url_host(F.col("url")).alias("domain")).distinct()
    rules = doms.join(F.broadcast(t), F.pmod(F.length("domain"), F.lit(4)) == F.col("bucket"))
    return rules.select(*[c.split()[0] for c in RULES_SCHEMA.split(", ")])


def _candidates(spark, sf_dir):
    from trawl.operators import crawlplan as cp
    p, seeds, edges = _crawl_inputs(spark, sf_dir)
    return p, cp.frontier_candidates(seeds, edges, p)


@plan("frontier_unvisited")
def frontier_unvisited(spark, sf_dir):
    """C7 + J6: seeds and link targets not yet visited."""
    return _candidates(spark, sf_dir)[1]


@plan("frontier_topn")
def frontier_topn(spark, sf_dir):
    """The bounded frontier (1000) in hash-priority order."""
    from trawl.operators import crawlplan as cp
    return cp.frontier_topn(_candidates(spark, sf_dir)[1])


@plan("robots_filter")
def robots_filter(spark, sf_dir):
    """Candidates allowed by their domain's rules."""
    from trawl.operators import crawlplan as cp
    p, cand = _candidates(spark, sf_dir)
    return cp.robots_filter(cand, _robots_rules(spark, p), CRAWL_AGENT)


@plan("politeness_plan")
def politeness_plan(spark, sf_dir):
    """Start offsets per domain for the allowed part of the frontier."""
    from trawl.operators import crawlplan as cp
    p, seeds, _ = _crawl_inputs(spark, sf_dir)
    rules = _robots_rules(spark, p)
    age = (F.length("domain") % LAST_REQUEST_MOD).cast("double")
    last = rules.select("domain", age.alias("age_s")).distinct().filter("age_s > 0")
    return cp.next_fetch_list(p, seeds, p, rules, agent=CRAWL_AGENT, last_requests=last)


@plan("politeness_violations")
def politeness_violations(spark, sf_dir):
    """Requests of one user (as domain) closer than its gap (a tenth of the users
    have a longer one); failed requests carry no user and are one domain."""
    from trawl.operators import crawlplan as cp
    log = inp.events(spark, sf_dir).withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    gaps = log.filter(F.col("user_id") % 10 == 0).select(F.col("user_id").alias("domain"), F.lit(2 * VIOLATION_GAP_S).alias("gap")).distinct()
    found = cp.politeness_violations(log, VIOLATION_GAP_S, domain_col="user_id", gaps=gaps)
    return found.withColumn("domain", F.coalesce("domain", F.lit(-1)))


@plan("events_success_only")
def events_success_only(spark, sf_dir):
    """P5: successful requests only."""
    from trawl.operators.pages import successful
    return successful(inp.events(spark, sf_dir), "event_type").select("event_id", "user_id", "event_type")


@plan("crawl_budget")
def crawl_budget(spark, sf_dir):
    """C11: the first 1000 successful fetches."""
    from trawl.operators import crawlplan as cp
    ok = inp.events(spark, sf_dir).filter(F.col("event_type") != "error")
    return cp.crawl_budget(ok, BUDGET_PAGES).select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@plan("visited_dedup")
def visited_dedup(spark, sf_dir):
    """One row per link target."""
    from trawl.operators import crawlplan as cp
    return cp.visited_dedup(_crawl_inputs(spark, sf_dir)[2])


@plan("crawl_progress")
def crawl_progress(spark, sf_dir):
    """Pages, elapsed seconds and rate at every 50th successful fetch."""
    from trawl.operators import crawlplan as cp
    return cp.crawl_progress(inp.events(spark, sf_dir).filter(F.col("event_type") != "error"))


@plan("pages_per_domain")
def pages_per_domain(spark, sf_dir):
    """C14: pages per host."""
    from trawl.operators import crawlplan as cp
    return cp.pages_per_domain(inp.pages(spark, sf_dir))


# ---------------------------------------------------------------- streaming
@plan("stream_visited_dedup")
def stream_visited_dedup(spark, sf_dir):
    """The pages table as a file stream; each link target once."""
    from trawl.streaming import dedup, runner
    runner.use_disk_state(spark)
    s = runner.file_stream(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
    return runner.run_available_now(dedup.new_link_targets(s.select("page_id", "url", "html")), "visited")


def _arrivals(df: DataFrame, key: str, parts: int):
    """The rows of ``df`` in ``parts`` runs by ``key``, each a batch of files more in the folder that is given back."""
    from trawl.session import scratch_path
    folder = scratch_path(df.sparkSession, "arrivals")
    top = df.agg(F.max(key)).first()[0] or 0
    for n in range(parts):
        df.filter(F.floor(F.col(key) * parts / (top + 1)) == n).write.mode("append").parquet(folder)
        yield folder


@plan("stream_first_seen")
def stream_first_seen(spark, sf_dir):
    """T1 over three runs with state that expires: each link target and the run that met it first."""
    from trawl.session import scratch_path
    from trawl.streaming import dedup, runner
    pages = inp.pages(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60))
    path, ends = scratch_path(spark, "visited"), []
    for folder in _arrivals(pages, "page_id", 3):
        dedup.first_seen(runner.file_stream(spark, folder), path, "30 minutes", "ts")
        ends.append(dedup.Visited(path).urls(spark).agg(F.max("batch")).first()[0])
    urls = dedup.Visited(path).urls(spark)
    return urls.select("url", sum((F.col("batch") > end).cast("int") for end in ends).alias("run"))


@plan("stream_politeness_rounds")
def stream_politeness_rounds(spark, sf_dir):
    """C9 over three rounds six seconds apart: all allowed candidates by the start of their
    hash, spaced from the domain's last request, which the stream carries."""
    from trawl.operators import crawlplan as cp
    from trawl.session import scratch_path
    from trawl.streaming import politeness, runner
    p, cand = _candidates(spark, sf_dir)
    prio = F.md5("url")
    nth = F.when(prio < "5", 0).when(prio < "a", 1).otherwise(2)
    allowed = cp.robots_filter(cand, _robots_rules(spark, p), CRAWL_AGENT).select(
        "domain", "url", prio.alias("prio"), "delay", nth.cast("long").alias("nth"), (nth * F.lit(ROUND_S)).alias("now_s"))
    path = scratch_path(spark, "politeness")
    for folder in _arrivals(allowed, "nth", 3):
        politeness.plan_stream(runner.file_stream(spark, folder).drop("nth"), path)
    plan = politeness.DomainClock(path).plan(spark)
    return plan.select("domain", "url", "pos", F.round("at_s", 6).alias("at_s"))


@plan("frontier_rounds")
def frontier_rounds(spark, sf_dir):
    """C7 + C8 over three rounds of fetched pages: each adds its own links and removes its own
    pages; what is then taken equals the frontier of one recomputation."""
    from trawl.operators import crawlplan as cp
    from trawl.operators.pages import link_edges
    from trawl.session import scratch_path
    from trawl.streaming.frontier import Frontier
    p, seeds, _ = _crawl_inputs(spark, sf_dir)
    top = p.agg(F.max("page_id")).first()[0] or 0
    kept = Frontier(scratch_path(spark, "frontier"))
    for n in range(3):
        pages = p.filter(F.floor(F.col("page_id") * 3 / (top + 1)) == n)
        found = link_edges(pages).select(F.col("dst_url").alias("url"))
        kept.add(found.unionByName(seeds.select("url")) if n == 0 else found, n, visited=pages.select("url"))
    return kept.take(2, cp.FRONTIER_SIZE)


@plan("stream_progress_closed")
def stream_progress_closed(spark, sf_dir):
    """T3 with a watermark: fetches arrive up to ten hours out of order in four runs; closed
    windows with their counts, and the rows that came too late for them."""
    from trawl.operators.pages import successful
    from trawl.session import scratch_path
    from trawl.streaming import progress, runner
    log = successful(inp.events(spark, sf_dir), "event_type")
    first = log.agg(F.min("ts").alias("t0"))
    hours = F.floor((F.unix_seconds("ts") - F.unix_seconds("t0")) / 3600) + F.col("event_id") % 10
    arriving = log.crossJoin(F.broadcast(first)).select("ts", hours.alias("hour"))  # one row
    done = progress.Progress(scratch_path(spark, "progress"), delay="4 hours")
    for folder in _arrivals(arriving, "hour", 4):
        done.run(runner.file_stream(spark, folder))
    late = done.late(spark).groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("late"))
    both = done.windows(spark).join(late, ["window_start", "window_end"], "full")
    return both.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                       F.coalesce("fetches", F.lit(0)).alias("fetches"), F.coalesce("late", F.lit(0)).alias("late"))


def _segments(spark, sf_dir, **options):
    """The documents in six runs of a stream, a segment each."""
    from trawl.session import scratch_path
    from trawl.streaming import runner, segments
    store = segments.Segments(scratch_path(spark, "segments"), **options)
    for folder in _arrivals(inp.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 6):
        segments.index_stream(runner.file_stream(spark, folder), store, title_col=None)
    return store


@plan("stream_segments")
def stream_segments(spark, sf_dir):
    """T2 + I6: six micro-batches as tiered segments, merged bucket by bucket; equals postings."""
    return _segments(spark, sf_dir, buckets=4, fan_in=3).index(spark).postings.select("term", "doc_id", "tf")


@plan("segments_profile")
def segments_profile(spark, sf_dir):
    """I8 + I9 from merged sketches of six segments: exact counts, and whether the number of
    terms and the median length are within the stated errors of the index' own."""
    store = _segments(spark, sf_dir, buckets=4, fan_in=3)
    index = store.index(spark).tokenized_once()
    exact = index.lexicon.agg(F.count("*").alias("real"))
    got = store.profile(spark).crossJoin(F.broadcast(exact))  # one row each
    ranks = index.doc_lengths.crossJoin(F.broadcast(got)).groupBy("documents", "tokens", "terms", "real").agg(
        F.avg((F.col("dl") < F.col("lengths")[0]).cast("int")).alias("below"), F.avg((F.col("dl") <= F.col("lengths")[0]).cast("int")).alias("upto"))
    return ranks.select("documents", "tokens", (F.abs(F.col("terms") / F.col("real") - 1) <= 0.03).alias("terms_close"),
                        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_close"))


@plan("index_versions")
def index_versions(spark, sf_dir):
    """X2 by document: every third document comes again without the letter e, every seventh is
    taken out, every 21st of these comes back; the latest version alone counts."""
    from trawl.session import scratch_path
    from trawl.streaming import segments
    docs = inp.table(spark, sf_dir, "documents").select("doc_id", "text")
    store = segments.Segments(scratch_path(spark, "segments"), buckets=4, fan_in=2, rule="documents")
    store.add(docs, 0, title_col=None)
    store.add(docs.filter("doc_id % 3 = 0").withColumn("text", F.translate("text", "e", " ")), 1, title_col=None)
    store.remove(docs.filter("doc_id % 7 = 0"), 2)
    store.add(docs.filter("doc_id % 147 = 0"), 3, title_col=None)
    return store.index(spark).postings.select("term", "doc_id", "tf", "dl")


def _streamed_index(spark, sf_dir) -> ix.Index:
    """The documents as a file stream, each micro-batch (all new files) a partial index."""
    from trawl.session import scratch_path
    from trawl.streaming import incremental, runner
    parts = scratch_path(spark, "parts")
    s = runner.file_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    runner.run_foreach_batch(s, "incremental-index", incremental.partial_writer(parts))
    return incremental.merged_index(spark, parts)


@plan("stream_incremental_index")
def stream_incremental_index(spark, sf_dir):
    """Documents indexed batch by batch, partials merged; equals postings."""
    return _streamed_index(spark, sf_dir).postings.select("term", "doc_id", "tf")


@plan("stream_index_bm25_topk")
def stream_index_bm25_topk(spark, sf_dir):
    """T2 + R4: the index merged from streamed partials answers like the batch index."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _streamed_index(spark, sf_dir).tokenized_once(), "bm25", inp.TOP_K))


@plan("stream_progress")
def stream_progress(spark, sf_dir):
    """Successful fetches per hour from the event stream, every window."""
    from trawl.operators.pages import successful
    from trawl.streaming import progress, runner
    s = runner.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    out = runner.run_updates(progress.progress_windows(successful(s, "event_type").select("ts")), "progress", progress.KEYS)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "fetches")


# ---------------------------------------------------------------- stemming
@plan("stemmed_postings")
def stemmed_postings(spark, sf_dir):
    """Postings over stemmed terms (surface forms folded, tf summed)."""
    return ix.build_index(inp.corpus(spark, sf_dir), stem=True, unique_ids=True).postings.select("term", "doc_id", "tf")


@plan("stemmed_bm25_topk")
def stemmed_bm25_topk(spark, sf_dir):
    """I10 + R4: BM25 top-10 with stemmed index and stemmed query terms."""
    return _rounded(rk.search(inp.bench_queries(spark, sf_dir), _ready(spark, sf_dir, stem=True), "bm25", inp.TOP_K))
