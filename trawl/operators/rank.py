"""Batch ranking: every query of a batch is answered by one DataFrame plan.

  queries -> (qid, term, qtf)                     narrow tokenize + small agg
          -> join lexicon (df) + stats (n, avgdl)  query side is small: broadcast
          -> postings of these terms dealt out      one shuffle of postings, whose size
             by document                            does not grow with the queries
          -> join the query side on term            broadcast
          -> groupBy(qid, doc_id) sum(qtf * s)      no shuffle: a document is in one task
          -> score >= floor of the query            the k-th score of some documents, so
                                                   few rows are rounded and sorted
          -> score > 0, top-k per qid              row_number <= k becomes a
                                                   WindowGroupLimit that also runs
                                                   before the shuffle
Ties are broken on the score rounded to 9 decimals, then the larger doc id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.functions.scoring import Ranker, resolve_ranker
from trawl.functions.stem import stem_terms
from trawl.functions.text import drop_stopwords, explode_nonempty, index_text, token_array
from trawl.operators.distribute import broadcast_if_small
from trawl.operators.index import DEFAULT_STOPWORDS, Index, block_count, block_of, unblocked

# Largest number of distinct query terms pushed into the index scans as a
# literal IN list (Parquet row-group skipping on a term-sorted index).
MAX_PUSHED_TERMS = 10_000
# Largest number of (query, term) rows broadcast into the postings join.
MAX_QUERY_TERM_ROWS = 2_000_000
# Largest number of per-query rows (one per query) broadcast back to matches.
MAX_BROADCAST_QUERIES = 2_000_000


def _maybe_broadcast(df: DataFrame, ok: bool) -> DataFrame:
    return F.broadcast(df) if ok else df


def few_queries(df: DataFrame, qid_col: str = "qid") -> bool:
    """Whether one row per query of ``df`` is small enough to broadcast."""
    return df.select(qid_col).distinct().limit(MAX_BROADCAST_QUERIES + 1).count() <= MAX_BROADCAST_QUERIES

_TIE_DIGITS = 9


def query_terms(queries: DataFrame, qid_col: str = "qid", query_col: str = "query",
                stopwords: Iterable[str] | None = DEFAULT_STOPWORDS, stem: bool = False) -> DataFrame:
    """(qid, term, qtf): query tokens parsed like documents, repeats counted."""
    arr = drop_stopwords(token_array(index_text(query_col, F.lit(""))), stopwords)
    if stem:
        arr = stem_terms(arr)
    toks = explode_nonempty(queries.select(F.col(qid_col).alias("qid"), arr.alias("_t")), "_t", "term", "qid")
    return toks.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))


def _restrict(index: Index, qterms: DataFrame, push_terms: bool) -> tuple[Callable[[DataFrame], DataFrame], int | None]:
    """A function that limits a table of the index to the query vocabulary, and the number
    of (qid, term) rows when it was learnt on the way.  The bucket folders that the
    vocabulary needs (at most as many numbers as the index has folders) are pushed
    as a partition filter however many terms there are; the terms themselves also go
    into the scans as a literal IN list while there are few."""
    folders = terms = n_rows = None
    if push_terms:
        per_term = qterms.groupBy("term").agg(F.count(F.lit(1)).alias("c"))
        if index.term_buckets and "tb" in index.postings.columns:
            from trawl.sources.index_store import term_bucket
            buckets = per_term.select(term_bucket(F.col("term"), index.term_buckets).alias("b")).distinct()
            folders = sorted(r.b for r in buckets.collect())
        rows = per_term.limit(MAX_PUSHED_TERMS + 1).collect()
        if len(rows) <= MAX_PUSHED_TERMS:
            terms = [r.term for r in rows]
            n_rows = sum(r.c for r in rows)

    def limit(df: DataFrame) -> DataFrame:
        if folders is not None and "tb" in df.columns:
            df = df.filter(F.col("tb").isin(folders))
        return df if terms is None else df.filter(term_in(terms))

    return limit, n_rows


def _sql_string(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def term_in(terms: list[str], col: str = "term") -> Column:
    """``col IN (terms)`` built as one SQL expression (one JVM call, not one per
    literal).  Past ``spark.sql.parquet.pushdown.inFilterThreshold`` values Parquet
    gets their range, and the exact test runs above the scan."""
    if not terms:
        return F.lit(False)
    return F.expr(f"`{col}` IN ({', '.join(_sql_string(t) for t in terms)})")


def _known_terms(queries: DataFrame, index: Index, qid_col: str, query_col: str,
                 push_terms: bool) -> tuple[Callable[[DataFrame], DataFrame], DataFrame, bool]:
    """A function that limits a table of the index to the query vocabulary, the query
    side (qid, term, qtf, df, n, avgdl), marked for broadcast if it is small, and whether it is.  It has at most as
    many rows as there are query terms (one lexicon row per term), so the size check runs on those alone and
    never evaluates the index."""
    qt = query_terms(queries, qid_col, query_col, index.stopwords, index.stem)
    limit, n_rows = _restrict(index, qt, push_terms)
    if n_rows is None:
        n_rows = qt.limit(MAX_QUERY_TERM_ROWS + 1).count()
    small = n_rows <= MAX_QUERY_TERM_ROWS
    known = limit(index.lexicon).join(_maybe_broadcast(qt, small), "term").crossJoin(F.broadcast(index.stats))  # one row of statistics
    return limit, _maybe_broadcast(known, small), small


def _term_score(ranker: str | Ranker) -> Column:
    return resolve_ranker(ranker)(F.col("tf"), F.col("df"), F.col("dl"), F.col("n").cast("double"), F.col("avgdl"))


def _scored(joined: DataFrame, ranker: str | Ranker) -> DataFrame:
    return joined.select("qid", "term", "qtf", "doc_id", _term_score(ranker).alias("s")).withColumn(
        "contrib", F.col("qtf") * F.col("s"))


def _contributions(post: DataFrame, known: DataFrame, ranker: str | Ranker) -> DataFrame:
    return _scored(post.join(known, "term"), ranker)


def term_contributions(queries: DataFrame, index: Index, ranker: str | Ranker = "bm25",
                       qid_col: str = "qid", query_col: str = "query", push_terms: bool = True) -> DataFrame:
    """(qid, term, qtf, doc_id, s, contrib): single-term score ``s`` of every
    posting of every known query term, ``contrib = qtf * s``."""
    limit, known, _ = _known_terms(queries, index, qid_col, query_col, push_terms)
    return _contributions(limit(index.postings), known, ranker)


def _by_document(post: DataFrame, tasks: int) -> DataFrame:
    """Postings dealt out by document, to tasks sized by ``_sum_tasks``.  Sums by (query, document) then
    need no shuffle, and a task's sums are those of its own documents."""
    return post.select("term", "doc_id", "tf", "dl").repartition(tasks, "doc_id")


# Sums by (query, document) that a task forms on average, at most: two hash maps hold them, some 150 bytes each.
SUMS_PER_TASK = 1 << 20


def _sum_tasks(post: DataFrame, known: DataFrame) -> int:
    """How many tasks to deal ``post`` out to: sized by the input, and by the sums by (query, document) that the
    stored query side ``known(qid, df, n, ...)`` can make of it, so that more queries do not fill a task's memory."""
    from trawl.sources.index_store import postings_tasks
    most = known.agg(F.sum("df").alias("met"), F.count_distinct("qid").alias("qids"), F.max("n").alias("n")).first()
    sums = min(most.met or 0, (most.n or 0) * (most.qids + 1))  # one more for a null id
    return max(postings_tasks(post), -(-sums // SUMS_PER_TASK))


# One document in so many is scored beforehand, for the floors of the queries.
FIRST_DOCS = 16
# Sums of the same terms in another order differ by less.
SLACK = 1e-9


def _first_docs(post: DataFrame, tasks: int = 0) -> tuple[DataFrame, int]:
    """The postings of these documents and the tasks to deal them out to, of ``tasks`` for all documents."""
    tasks = max(tasks // FIRST_DOCS, post.sparkSession.sparkContext.defaultParallelism)
    return post.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_DOCS)) == 0), tasks


def _floors(scored: DataFrame, k: int, *keys: str) -> DataFrame:
    """(keys, _floor): the k-th score of ``scored``, documents with their whole scores.  The k-th
    score of all documents is not below that of some of them.  Written; a row per key at most."""
    by_score = Window.partitionBy(*keys).orderBy(F.col("score").desc())
    kth = scored.withColumn("_r", F.row_number().over(by_score)).filter(F.col("_r") == k)
    return F.broadcast(_written(kth.select(*keys, F.col("score").alias("_floor")), "floors"))


def _reaching(scored: DataFrame, floors: DataFrame, *keys: str) -> DataFrame:
    """``scored`` without what is below its floor; all of a key that has none.  Scores that
    round as the floor does stay, so ties are not touched."""
    floor = F.col("_floor")
    least = floor - 2 * SLACK - F.abs(floor) * SLACK
    return scored.join(floors, list(keys), "left").filter(
        floor.isNull() | (F.col("score") >= floor) | (F.col("score") >= least)).drop("_floor")


def score_documents(contrib: DataFrame) -> DataFrame:
    """(qid, doc_id, score, matched): summed score and number of distinct query
    terms found in the document; zero (and null) scores dropped."""
    agg = contrib.groupBy("qid", "doc_id").agg(F.sum("contrib").alias("score"),
                                               F.count(F.lit(1)).alias("matched"))
    return agg.filter(F.col("score") > 0)


def _rs(score: Column | str = "score") -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.round(c, _TIE_DIGITS)


def top_k(scored: DataFrame, k: int = 10, mode: str = "exact", small_batch: bool | None = None) -> DataFrame:
    """(qid, rank, doc_id, score) from (qid, doc_id, score).  ``small_batch``
    says whether one row per query may be broadcast (checked when None)."""
    if k <= 0:
        return scored.select("qid", F.lit(0).alias("rank"), "doc_id", "score").limit(0)
    scored = scored.withColumn("_rs", _rs())
    if mode == "floor":
        scored = _floor_candidates(scored, k, small_batch)
    elif mode != "exact":
        raise ValueError("mode must be 'exact' or 'floor'")
    w = Window.partitionBy("qid").orderBy(F.col("_rs").desc(), F.col("doc_id").desc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("qid", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def _floor_candidates(scored: DataFrame, k: int, small_batch: bool | None = None) -> DataFrame:
    """Documents the reference's heap keeps when its threshold is the heap
    minimum after every push (closed form, see README):
    d0 = smallest doc id, s0 its score; C = {d0} + {score > s0};
    t = k-th best score in C (or the lowest); E = C with score >= t;
    keep score > t, or position <= k in doc-id order within E."""
    if small_batch is None:
        small_batch = few_queries(scored)
    # Both uses of ``scored`` share its exchange; only documents above their query's
    # first score are stored (reliable checkpoint), for the branches below.
    first = scored.groupBy("qid").agg(F.min_by("_rs", "doc_id").alias("_s0"), F.min("doc_id").alias("_d0"))
    c = scored.join(_maybe_broadcast(first, small_batch), "qid").filter(
        (F.col("doc_id") == F.col("_d0")) | (F.col("_rs") > F.col("_s0"))).checkpoint(eager=True)
    by_score = Window.partitionBy("qid").orderBy(F.col("_rs").desc(), F.col("doc_id").desc())
    t = (c.withColumn("_r", F.row_number().over(by_score)).filter(F.col("_r") <= k)
         .groupBy("qid").agg(F.min("_rs").alias("_t")))
    e = c.join(_maybe_broadcast(t, small_batch), "qid").filter(F.col("_rs") >= F.col("_t"))
    by_doc = Window.partitionBy("qid").orderBy(F.col("doc_id").asc())
    # Only the first k ties (by doc id) can pass the position test.
    ties = (e.filter(F.col("_rs") == F.col("_t")).withColumn("_r", F.row_number().over(by_doc))
            .filter(F.col("_r") <= k).drop("_r"))
    u = e.filter(F.col("_rs") > F.col("_t")).unionByName(ties)
    u = u.withColumn("_p", F.row_number().over(by_doc))
    return u.filter((F.col("_rs") > F.col("_t")) | (F.col("_p") <= k)).select(scored.columns)


def search(queries: DataFrame, index: Index, ranker: str | Ranker = "bm25", k: int = 10,
           mode: str = "exact", match: str = "any", prune: bool = False,
           qid_col: str = "qid", query_col: str = "query", push_terms: bool = True) -> DataFrame:
    """Top-k documents per query: (qid, rank, doc_id, score).  ``prune`` skips document
    blocks that cannot reach a query's top-k (with ``match="any"`` and ``mode="exact"``)."""
    if match not in ("any", "all"):
        raise ValueError("match must be 'any' or 'all'")
    limit, known, small = _known_terms(queries, index, qid_col, query_col, push_terms)
    small_batch = few_queries(queries, qid_col) if mode == "floor" else None
    if match == "all":
        need = query_terms(queries, qid_col, query_col, index.stopwords, index.stem).groupBy("qid").agg(
            F.count(F.lit(1)).alias("need"))
        scored = _all_term_scores(limit, known, need, index, ranker)
    elif prune and mode == "exact":
        scored = _cut_scores(limit, known, index, ranker, k)
    elif small:
        post, known = limit(index.postings), F.broadcast(_written(known, "known-terms"))
        tasks = _sum_tasks(post, known)
        of = lambda some, tasks: score_documents(_contributions(_by_document(some, tasks), known, ranker))
        scored = of(post, tasks)
        if mode == "exact" and k > 0:
            scored = _reaching(scored, _floors(of(*_first_docs(post, tasks)), k, "qid"), "qid")
    else:
        scored = score_documents(_contributions(limit(index.postings), known, ranker))
    return top_k(scored.select("qid", "doc_id", "score"), k, mode, small_batch)


def search_many(queries: DataFrame, index: Index, rankers: dict[str, str | Ranker], k: int = 10,
                qid_col: str = "qid", query_col: str = "query", push_terms: bool = True) -> DataFrame:
    """Exact top-k of several rankers from one postings scan and one join:
    (ranker, qid, rank, doc_id, score).  Every ranker's contribution is a
    column of the same joined rows; one aggregation sums them all, and the
    per-ranker rows are unpivoted before the per-(ranker, query) top-k."""
    names = list(rankers)
    score_fns = {n: resolve_ranker(r) for n, r in rankers.items()}
    limit, known, small = _known_terms(queries, index, qid_col, query_col, push_terms)
    post = limit(index.postings)
    args = (F.col("tf"), F.col("df"), F.col("dl"), F.col("n").cast("double"), F.col("avgdl"))
    tasks = 0
    if small:
        known = F.broadcast(_written(known, "known-terms"))
        tasks = _sum_tasks(post, known)

    def scores(some: DataFrame, tasks: int) -> DataFrame:
        joined = (_by_document(some, tasks) if small else some).join(known, "term")
        contrib = joined.select("qid", "doc_id", *[(F.col("qtf") * score_fns[n](*args)).alias(f"_c{i}")
                                                    for i, n in enumerate(names)])
        summed = contrib.groupBy("qid", "doc_id").agg(*[F.sum(f"_c{i}").alias(f"_s{i}") for i in range(len(names))])
        stacked = summed.select("qid", "doc_id", F.explode(F.array(*[
            F.struct(F.lit(n).alias("ranker"), F.col(f"_s{i}").alias("score")) for i, n in enumerate(names)])).alias("_x"))
        found = stacked.select(F.col("_x.ranker").alias("ranker"), "qid", "doc_id", F.col("_x.score").alias("score"))
        return found.filter(F.col("score") > 0)

    scored = scores(post, tasks)
    if small and k > 0:
        scored = _reaching(scored, _floors(scores(*_first_docs(post, tasks)), k, "ranker", "qid"), "ranker", "qid")
    scored = scored.withColumn("_rs", _rs())
    w = Window.partitionBy("ranker", "qid").orderBy(F.col("_rs").desc(), F.col("doc_id").desc())
    ranked = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("ranker", "qid", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def term_upper_bounds(queries: DataFrame, index: Index, ranker: str | Ranker = "bm25",
                      qid_col: str = "qid", query_col: str = "query") -> DataFrame:
    """(qid, term, qtf, ub): the largest single-term score of each known query term.  Of
    posting blocks, and with a built-in ranker, only those are unpacked whose largest tf and
    smallest length promise more than the best posting of the most promising one."""
    if index.blocks_table is None or not isinstance(ranker, str):
        contrib = term_contributions(queries, index, ranker, qid_col, query_col)
        return contrib.groupBy("qid", "term", "qtf").agg(F.max("s").alias("ub"))
    limit, known, _ = _known_terms(queries, index, qid_col, query_col, True)
    terms = _written(known, "known-terms")
    lists = broadcast_if_small(terms.select("term", "df", "n", "avgdl").distinct(), MAX_QUERY_TERM_ROWS)
    blocks = limit(index.blocks())
    promised = _written(blocks.select("term", "block", F.col("max_tf").alias("tf"), F.col("min_dl").alias("dl")).join(lists, "term")
                        .select("term", "block", "df", "n", "avgdl", _term_score(ranker).alias("u")), "block-bounds")

    def best(need: DataFrame) -> DataFrame:
        met = blocks.select("term", "block", "posts").join(broadcast_if_small(need, MAX_QUERY_TERM_ROWS), ["term", "block"])
        flat = met.withColumn("_p", F.explode("posts")).select("term", "df", "n", "avgdl", "_p.tf", "_p.dl")
        return flat.groupBy("term").agg(F.max(_term_score(ranker)).alias("ub"))

    leading = promised.groupBy("term").agg(F.max_by("block", F.struct("u", "block")).alias("block"))
    first = _written(best(promised.join(leading, ["term", "block"], "left_semi")), "term-bests")
    rest = promised.join(leading, ["term", "block"], "left_anti").join(first, "term").filter(F.col("u") > F.col("ub"))
    ub = first.unionByName(best(rest.drop("ub"))).groupBy("term").agg(F.max("ub").alias("ub"))
    return terms.select("qid", "term", "qtf").join(ub, "term")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again."""
    from trawl.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lists(limit: Callable[[DataFrame], DataFrame], known: DataFrame, index: Index) -> tuple[DataFrame, DataFrame]:
    """The index' posting blocks of the query vocabulary, and ``known`` with ``blocks``, the
    number that each term's list has."""
    blocks = limit(index.blocks())
    if index.blocks_table is None:
        blocks = _written(blocks, "blocks")  # made for this search
    return blocks, known.withColumn("blocks", block_count(F.col("df"), index.block_docs))


def _whole_lists(blocks: DataFrame, terms: DataFrame, ranker: str | Ranker) -> DataFrame:
    """The contributions of all postings of ``terms(qid, term, ...)``."""
    met = blocks.select("term", "posts").join(broadcast_if_small(terms, MAX_QUERY_TERM_ROWS), "term")
    flat = met.withColumn("_p", F.explode("posts"))
    return _scored(flat.select("qid", "term", "qtf", "df", "n", "avgdl", "_p.doc_id", "_p.tf", "_p.dl"), ranker)


# Documents that are looked up in a block at once, on average at most, the rows of such
# lists that are broadcast, and what stands for a missing id in them.
GATHERED = 1024
MAX_GATHERED_ROWS = 50_000
NO_ID = -(1 << 63)


def _looked_up(blocks: DataFrame, terms: DataFrame, docs: DataFrame, ranker: str | Ranker) -> DataFrame:
    """The contributions of ``terms(qid, term, ..., blocks)`` to the documents ``docs(qid, doc_id)``
    of the same query.  The documents are gathered by the block they fall into; blocks without
    any meet no row, and of the others only these documents' postings are unpacked.  Where
    a query has far more documents than its list has blocks, they are gathered in parts."""
    per_query = docs.groupBy("qid").agg(F.count(F.lit(1)).alias("_n"))
    sizes = terms.select("qid", "blocks").distinct().join(per_query, "qid").select(
        "qid", "blocks", F.ceil(F.col("_n") / (F.col("blocks") * GATHERED)).alias("_parts"))
    key = lambda d: F.coalesce(d, F.lit(NO_ID))
    places = docs.join(broadcast_if_small(sizes), "qid").groupBy(
        "qid", "blocks", block_of(F.col("doc_id"), F.col("blocks")).alias("block"),
        F.pmod(F.hash("doc_id"), F.col("_parts")).alias("_part")).agg(F.collect_list(key(F.col("doc_id"))).alias("ids"))
    need = broadcast_if_small(places.drop("_part").join(terms, ["qid", "blocks"]), MAX_GATHERED_ROWS)
    met = blocks.select("term", "block", "posts").join(need, ["term", "block"])
    hits = met.withColumn("_p", F.explode(F.filter("posts", lambda p: F.array_contains(F.col("ids"), key(p["doc_id"])))))
    return _scored(hits.select("qid", "term", "qtf", "df", "n", "avgdl", "_p.doc_id", "_p.tf", "_p.dl"), ranker)


def _dealt_lists(blocks: DataFrame, terms: DataFrame, ranker: str | Ranker, tasks: int) -> DataFrame:
    """``_whole_lists`` with every document's rows in one of ``tasks`` tasks: a list that many
    queries share is unpacked and shuffled once."""
    terms = broadcast_if_small(terms, MAX_QUERY_TERM_ROWS)
    lists = blocks.select("term", "posts").join(terms.select("term").distinct(), "term", "left_semi")
    return _contributions(_by_document(unblocked(lists), tasks), terms, ranker)


# The k-th score is first estimated from the lists that promise this share of a query's score.
FIRST_SHARE = 0.5


def _cut_scores(limit: Callable[[DataFrame], DataFrame], known: DataFrame, index: Index, ranker: str | Ranker, k: int) -> DataFrame:
    """(qid, doc_id, score) of the documents that can reach a query's top-k.

    The largest tf and smallest length of a list bound what its term adds to any document,
    for rankers that grow with tf and fall with the length, as both built-in ones do.

    1. The lists that promise most, usually the short ones, are summed; the k-th sum is a
       floor for the k-th score.
    2. Terms whose bounds together stay below the floor cannot lift a document to it alone.
       All other lists are added, which may raise the floor, and documents that stay below
       it with all that the common terms could add are dropped.
    3. Of the common lists, the longest ones, only the postings of the documents left are
       unpacked, from the blocks they fall into.

    Result-neutral: a dropped document's score is below the k-th.  No list is unpacked twice."""
    from trawl.sources.index_store import postings_tasks
    blocks, known = _lists(limit, known, index)
    tasks = postings_tasks(blocks)
    promised = limit(index.list_bounds()).join(known, "term").withColumn("u", F.col("qtf") * _term_score(ranker))
    descending = Window.partitionBy("qid").orderBy(F.col("u").desc(), F.col("term").desc())
    before = F.coalesce(F.sum("u").over(descending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ascending = Window.partitionBy("qid").orderBy("u", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    terms = _written(promised.select("qid", "term", "qtf", "df", "n", "avgdl", "blocks", "u").withColumns({
        "first": before < FIRST_SHARE * F.sum("u").over(Window.partitionBy("qid")), "upto": F.sum("u").over(ascending)}), "term-bounds")
    by_part = Window.partitionBy("qid").orderBy(F.col("part").desc())

    def added(contrib: DataFrame) -> DataFrame:
        return contrib.select("qid", "doc_id", F.col("contrib").alias("part"))

    def summed(parts: DataFrame) -> DataFrame:
        return parts.groupBy("qid", "doc_id").agg(F.sum("part").alias("part"))

    def floor_of(parts: DataFrame) -> DataFrame:
        return (parts.withColumn("r", F.row_number().over(by_part)).filter(F.col("r") == k)
                .select("qid", (F.col("part") - SLACK).alias("floor")))

    first = _written(summed(added(_dealt_lists(blocks, terms.filter("first"), ranker, tasks))), "first-sums")
    split = _written(terms.join(floor_of(first), "qid", "left").withColumn(
        "common", ~F.col("first") & (F.col("upto") < F.coalesce("floor", F.lit(0.0)))), "term-split")
    other = added(_dealt_lists(blocks, split.filter("not first and not common"), ranker, tasks))
    rest = split.groupBy("qid").agg(F.sum(F.when(F.col("common"), F.col("u")).otherwise(0.0)).alias("rest"), F.max("floor").alias("floor"))
    few = few_queries(rest)

    def reaching(parts: DataFrame, rest: DataFrame) -> DataFrame:
        return (parts.join(_maybe_broadcast(rest, few), "qid").filter(F.col("part") + F.col("rest") >= F.coalesce("floor", F.lit(0.0)))
                .select("qid", "doc_id", "part"))

    # Both sides are dealt out alike, so their sums need no other shuffle; what is below the first floor is not stored.
    both = first.repartition(tasks, "doc_id").unionByName(other)
    parts = _written(reaching(summed(both), rest), "rare-sums")
    left = _written(reaching(parts, rest.drop("floor").join(floor_of(parts), "qid", "left")), "candidates")
    common = split.filter("common").select("qid", "term", "qtf", "df", "n", "avgdl", "blocks")
    full = summed(left.unionByName(added(_looked_up(blocks, common, left, ranker))))
    return full.select("qid", "doc_id", F.col("part").alias("score")).filter(F.col("score") > 0)


def _all_term_scores(limit: Callable[[DataFrame], DataFrame], known: DataFrame, need: DataFrame, index: Index,
                     ranker: str | Ranker) -> DataFrame:
    """(qid, doc_id, score) of the documents that hold all of a query's terms.

    A query with an unknown term has none.  The documents of its rarest term are the
    candidates, the second rarest is looked up for these, and all others for those left, so
    longer lists are unpacked only where a candidate can stand in them."""
    blocks, known = _lists(limit, known, index)
    complete = known.groupBy("qid").agg(F.count(F.lit(1)).alias("has")).join(need, "qid").filter(F.col("has") == F.col("need")).select("qid")
    terms = _written(known.join(complete, "qid", "left_semi").withColumn(
        "r", F.row_number().over(Window.partitionBy("qid").orderBy("df", "term"))), "term-order")

    def added(hits: DataFrame) -> DataFrame:
        return hits.select("qid", "doc_id", F.col("contrib").alias("part"), F.lit(1).alias("found"))

    left = _written(added(_whole_lists(blocks, terms.filter("r = 1").drop("r"), ranker)), "candidates")
    for which in ("r = 2", "r > 2"):
        step = terms.filter(which).drop("r")
        if step.isEmpty():
            break
        both = left.unionByName(added(_looked_up(blocks, step, left, ranker)))
        upto = terms.filter("r <= 2" if which == "r = 2" else "r > 0").groupBy("qid").agg(F.count(F.lit(1)).alias("upto"))
        summed = both.groupBy("qid", "doc_id").agg(F.sum("part").alias("part"), F.sum("found").cast("int").alias("found"))
        left = _written(summed.join(broadcast_if_small(upto), "qid").filter(F.col("found") == F.col("upto")).drop("upto"), "candidates")
    return left.select("qid", "doc_id", F.col("part").alias("score")).filter(F.col("score") > 0)


def format_results(ranked: DataFrame) -> DataFrame:
    """(qid, rank, ID, Score): 7-digit zero-padded id, score to 4 decimals."""
    return ranked.select("qid", "rank", F.format_string("%07d", F.col("doc_id")).alias("ID"),
                         F.round("score", 4).alias("Score"))


def results_per_query(queries: DataFrame, ranked: DataFrame, qid_col: str = "qid",
                      query_col: str = "query") -> DataFrame:
    """One row per query line, also without hits: (qid, Query, Results)."""
    fr = format_results(ranked)
    per_q = fr.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "ID", "Score"))).alias("_r"))
    res = F.transform(F.coalesce(F.col("_r"), F.array()), lambda x: F.struct(x["ID"].alias("ID"),
                                                                           x["Score"].alias("Score")))
    q = queries.select(F.col(qid_col).alias("qid"), F.col(query_col).alias("Query"))
    return q.join(per_q, "qid", "left").select("qid", "Query", res.alias("Results"))


def results_json(results: DataFrame) -> DataFrame:
    """(qid, json) with one ``{"Query": ..., "Results": [{"ID", "Score"}]}`` per query."""
    return results.select("qid", F.to_json(F.struct("Query", "Results")).alias("json"))
