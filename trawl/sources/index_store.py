"""Persisting and opening an index.

Layout under ``path``:
  postings/tb=*/ (term, doc_id, tf, dl) in folders by term bucket
                pmod(xxhash64(term), term_buckets): a query batch reads only the
                folders of its terms' buckets (partition pruning at planning
                time, no footers opened elsewhere).  Inside, range-partitioned
                and sorted on
                (term, doc_id) (``layout="range"``, default): files cover
                disjoint term ranges, so a pushed-down ``term IN (...)`` skips
                whole files by their statistics, and a very frequent term is
                split over several files.  ``layout="sorted"`` saves the range
                shuffle at build time but every file then spans all terms and
                only page-level statistics can skip.
                ``layout="blocks"`` stores posting blocks instead, rows (term, block, n,
                max_tf, min_dl, posts) sorted on (term, block): some hundred (doc_id, tf, dl)
                of one term each.  A search with ``prune`` or ``match="all"`` reads the
                columns it rules lists out by, and unpacks the blocks it needs only.
                The postings are written once more for it, as a term's number of blocks
                follows from its df.
  lexicon/      (term, df), each file sorted on term
  doc_lengths/  (doc_id, dl)
  stats/        one row (n, avgdl)
  meta/         one row: how the index was made (stem, stop words, term buckets, block size or null)
The corpus is tokenized once: the lexicon is derived from the written
postings, and document lengths from the one reserved-term row per document
that the postings carry (``LENGTH_TERM``).  Opening reads ``stats`` and ``meta``, two
rows; queries are parsed as the documents were, by what ``meta`` says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.index import LENGTH_TERM, Index, collection_stats, lexicon_from_postings, posting_blocks, unblocked, with_blocks

# Term-hash buckets of the postings directory (``tb=<n>`` sub-folders), one per so
# many bytes of estimated corpus size.
BYTES_PER_BUCKET = 1 << 30
# Estimated input bytes for each task that postings are dealt out to: up to a million
# postings, which a task sorts and gathers in memory (some 180 bytes each).
BYTES_PER_TASK = 4 << 20

META_SCHEMA = "stem boolean, stopwords array<string>, term_buckets int, block_docs long"

POSTINGS_SCHEMA = "term string, doc_id long, tf long, dl long, tb int"
BLOCKS_SCHEMA = ("term string, block long, n long, max_tf long, min_dl long, posts array<struct<doc_id: long, tf: long, dl: long>>, tb int")


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of the tables that ``df`` reads, from the listings it already
    has; None if it does not know (Spark then reports ``spark.sql.defaultSizeInBytes``)."""
    def leaves(node):
        kids = node.children()
        if kids.size() == 0:
            yield int(str(node.stats().sizeInBytes()))
        for i in range(kids.size()):
            yield from leaves(kids.apply(i))

    size = sum(leaves(df._jdf.queryExecution().optimizedPlan()))
    return size if size < 1 << 62 else None


def postings_tasks(df: DataFrame) -> int:
    """How many tasks to deal postings out to that ``df`` makes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(df)
    if size is None:
        return max(cores, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return int(max(size // BYTES_PER_TASK, cores))


def term_bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(index: Index, path: str, mode: str = "overwrite", layout: str = "range",
                term_buckets: int | None = None) -> None:
    base = path.rstrip("/")
    spark = index.postings.sparkSession
    source = index.combined if index.combined is not None else index.postings
    size = plan_bytes(source)
    term_buckets = term_buckets or max(1, (size or 0) // BYTES_PER_BUCKET)
    with_tb = lambda df: df.withColumn("tb", term_bucket(F.col("term"), term_buckets))
    tasks = postings_tasks(source)
    real = F.col("term") != LENGTH_TERM
    if layout == "blocks" or layout == "range" and index.combined is not None:
        # Range bounds are drawn from a first look at the rows, so these are stored before.
        index = index.tokenized_once()
        source = index.combined
    if layout == "blocks":
        lexicon = spark.read.schema("term string, df long").parquet(_written_lexicon(index.postings, base, mode))
        lists = with_blocks(source.select("term", "doc_id", "tf", "dl"), _with_lengths(lexicon, source), index.block_docs)
        # All postings of a block meet in a task of this shuffle, so they are gathered without another.
        keys = ["tb", "term", "block"]
        post = posting_blocks(with_tb(lists).repartitionByRange(tasks, *keys), "tb")
    elif layout in ("range", "sorted"):
        # (tb, term, doc_id): each task covers a contiguous run of buckets and
        # terms, so a bucket folder holds few files and a hot term is split.
        keys = ["tb", "term", "doc_id"]
        post = with_tb(source.select("term", "doc_id", "tf", "dl"))
        post = post.repartitionByRange(tasks, *keys) if layout == "range" else post
    else:
        raise ValueError("layout must be 'blocks', 'range' or 'sorted'")
    # Static overwrite: a smaller index over a larger one must not leave old bucket folders behind.
    (post.sortWithinPartitions(*keys)
     .write.mode(mode).option("partitionOverwriteMode", "static")
     .option("parquet.bloom.filter.enabled#term", "true").partitionBy("tb").parquet(f"{base}/postings"))
    written = spark.read.schema(post.schema).parquet(f"{base}/postings")  # an empty index has no file to tell
    if layout == "blocks":
        written = unblocked(written, "tb")
    else:
        _written_lexicon(written.filter(real), base, mode)
    if index.combined is not None:
        # The length rows: one bucket folder (pruned), first rows of its sort.
        lengths = (written.filter((F.col("tb") == term_bucket(F.lit(LENGTH_TERM), term_buckets)) & ~real)
                   .select("doc_id", F.col("dl").cast("long").alias("dl")))
    else:
        lengths = index.doc_lengths
    lengths.write.mode(mode).parquet(f"{base}/doc_lengths")
    collection_stats(spark.read.parquet(f"{base}/doc_lengths")).coalesce(1).write.mode(mode).parquet(f"{base}/stats")
    stop = None if index.stopwords is None else list(index.stopwords)
    size = index.block_docs if layout == "blocks" else None
    spark.createDataFrame([(index.stem, stop, int(term_buckets), size)], META_SCHEMA).coalesce(1).write.mode(mode).parquet(
        f"{base}/meta")


def _written_lexicon(post: DataFrame, base: str, mode: str) -> str:
    """Lexicon: partial counts per file, one shuffle of distinct terms, each
    file sorted on term (page statistics skip for a term lookup)."""
    lexicon_from_postings(post).sortWithinPartitions("term").write.mode(mode).parquet(f"{base}/lexicon")
    return f"{base}/lexicon"


def _with_lengths(lexicon: DataFrame, source: DataFrame) -> DataFrame:
    """The lexicon and the reserved term of the length rows, so that these are blocked too."""
    return lexicon.unionByName(source.filter(F.col("term") == LENGTH_TERM).agg(F.lit(LENGTH_TERM).alias("term"), F.count(F.lit(1)).alias("df")))


def read_index(spark: SparkSession, path: str) -> Index:
    base = path.rstrip("/")
    made = spark.read.schema(META_SCHEMA).parquet(f"{base}/meta").first()
    if spark.read.parquet(f"{base}/stats").first().n:
        stored = spark.read.parquet(f"{base}/postings")
    else:  # no file that tells the columns
        stored = spark.createDataFrame([], BLOCKS_SCHEMA if made.block_docs else POSTINGS_SCHEMA)
    stored = stored.filter(F.col("term") != LENGTH_TERM)
    blocks = {} if made.block_docs is None else {"blocks_table": stored, "block_docs": made.block_docs}
    return Index(postings=unblocked(stored, "tb") if blocks else stored,
                 lexicon=spark.read.parquet(f"{base}/lexicon"),
                 doc_lengths=spark.read.parquet(f"{base}/doc_lengths"),
                 stem=made.stem, stopwords=None if made.stopwords is None else tuple(made.stopwords),
                 stats_table=spark.read.parquet(f"{base}/stats"), term_buckets=made.term_buckets, **blocks)


def lookup(index: Index, terms: DataFrame | list[str]) -> DataFrame:
    """Postings of the given terms.  A Python list becomes a Parquet-pushed
    IN filter; a DataFrame of terms becomes a left-semi join (broadcast when
    the term list is small)."""
    if isinstance(terms, list):
        from trawl.operators.rank import term_in
        post = index.postings
        if index.term_buckets and "tb" in post.columns:
            rows = (post.sparkSession.createDataFrame([(t,) for t in terms], "term string")
                    .select(term_bucket(F.col("term"), index.term_buckets).alias("b")).distinct().collect())
            post = post.filter(F.col("tb").isin([r.b for r in rows]))
        return post.filter(term_in(terms))
    from trawl.operators.distribute import broadcast_if_small
    return index.postings.join(broadcast_if_small(terms.select("term").distinct()), "term", "left_semi")
