"""Benchmark decontamination through a positional inverted index.

``build_index`` stores the postings ``(term, doc_id, th, pos)`` of the training
documents for the terms that a test set uses (``th``: hash of the text, tells apart
rows that share a doc_id), written once as Parquet.  A document's length is the
posting of a blank, which no term can be.  ``phrase_matches`` takes the phrases of
the test set, orders their terms from the rarest by the index' own counts, shifts the
rarest list by its offset to get candidate starts, intersects them with the lists of
the two next rarest terms and, for what is left, with the lists of all others.  A
term with very many postings is only looked up at the positions that candidates ask
for, so no list is multiplied by the phrases that use it.  ``near_matches`` finds the
rarest terms of an item close together in any order.

Everything is DataFrame operations.  Tables of the test set's size are broadcast only
below ``BROADCAST_ROWS`` rows, otherwise joined by a shuffle; hashes of candidate texts
only below ``BROADCAST_TEXTS``, otherwise the lists are joined whole.

Defined results: null and empty texts have no words, no hits, and still get a row;
rows that are equal in doc_id and text get equal results, a row each; items without
words are ignored; an item_id that is null marks words but is neither counted nor
listed; empty tables give empty results or no hits; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.llm.common import ALNUM_GAP, ascii_lower, small, stored

WINDOW = 10
#: Terms whose lists are intersected before all others are.
RAREST = 3
#: Words that the rarest terms of an item may span to be a near match.
#: Share of an item's different terms that must have postings for a near match.
NEAR_SEEN_PCT = 60
NEAR_SPAN = 20
LENGTH = " "
BROADCAST_ROWS = 200_000
#: Texts whose hashes are broadcast to leave out the postings of all others.
BROADCAST_TEXTS = 1_000_000


def words(text: Column) -> Column:
    """The words of a text; cutting at what is between them is much faster than extracting them."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_GAP), "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


@dataclass(frozen=True)
class PositionalIndex:
    """Stored postings, and the number of postings of each term."""

    postings: DataFrame
    counts: DataFrame

    def lengths(self) -> DataFrame:
        """``(doc_id, th, n_words)``, a row for each indexed row."""
        return self.postings.where(F.col("term") == LENGTH).select(
            "doc_id", "th", F.col("pos").cast("long").alias("n_words"))


def items_with_words(items: DataFrame) -> DataFrame:
    """``(item_id, words)`` of the items that have any."""
    return (items.select("item_id", words(F.col("text")).alias("words"))
            .where(F.size("words") > 0).distinct())


def build_index(docs: DataFrame, items: DataFrame) -> PositionalIndex:
    """Postings of ``docs(doc_id, text)`` for every term of ``items(item_id, words)``."""
    vocabulary = stored(items.select(F.explode("words").alias("term"))
                        .unionAll(items.sparkSession.range(1).select(F.lit(LENGTH).alias("term")))
                        .distinct(), "decontam-terms")
    tokens = docs.select("doc_id", text_hash(F.col("text")).alias("th"), F.posexplode(
        F.concat(words(F.col("text")), F.array(F.lit(LENGTH)))).alias("pos", "term"))
    postings = stored(tokens.join(small(vocabulary, BROADCAST_ROWS), "term", "left_semi")
                      .select("term", "doc_id", "th", "pos"), "decontam-postings")
    counts = stored(postings.where(F.col("term") != LENGTH).groupBy("term")
                    .agg(F.count("*").alias("n")), "decontam-counts")
    return PositionalIndex(postings, counts)


def phrases_of(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(phrase, item_id, words)``: every window of ``width`` words, or the whole item if shorter."""
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (items.select("item_id", F.explode(F.transform(
                F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, width))).alias("words"))
            .select(F.array_join("words", " ").alias("phrase"), "item_id", "words").distinct())


def _rarest_first(index: PositionalIndex, lists: DataFrame, key: str, seen_pct: int = 100) -> DataFrame:
    """``lists(key, term, at)`` of the terms that have postings, with ``rank`` 1 for the rarest.
    Keys of whose terms fewer than ``seen_pct`` percent have postings are left out: for a
    phrase all must, as nothing can match it otherwise."""
    counted = lists.join(small(index.counts, BROADCAST_ROWS), "term", "left")
    by = Window.partitionBy(key)
    enough = 100 * F.count("n").over(by) >= seen_pct * F.count("*").over(by)
    return (counted.withColumn("enough", enough).where("enough and n is not null")
            .withColumn("rank", F.row_number().over(by.orderBy("n", "term", "at"))).drop("enough", "n"))


def _same_doc(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def _standing(cand: DataFrame, asked: DataFrame, postings: DataFrame) -> DataFrame:
    """The candidates ``(doc_id, th, start, phrase)`` of which every asked
    ``(phrase, term, at)`` has a posting at ``start + at``."""
    need = cand.join(asked, "phrase").select(
        "doc_id", "th", "start", "phrase", "n_asked", "term", (F.col("start") + F.col("at")).alias("pos"))
    at = (_same_doc(need, postings) & (need["pos"] == postings["pos"]) & (need["term"] == postings["term"]))
    return (need.join(postings, at, "left_semi")
            .groupBy("doc_id", "th", "start", "phrase").agg(F.count("*").alias("n"), F.first("n_asked").alias("n_asked"))
            .where(F.col("n") == F.col("n_asked")).select("doc_id", "th", "start", "phrase"))


def _asked(ranked: DataFrame, condition: Column) -> DataFrame:
    return ranked.where(condition).select(
        "phrase", "term", "at", F.count("*").over(Window.partitionBy("phrase")).alias("n_asked"))


def phrase_matches(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """Exact occurrences ``(doc_id, th, start, phrase)`` of ``phrases(phrase, words)``."""
    lists = phrases.select("phrase", "words").distinct().select(
        "phrase", F.posexplode("words").alias("at", "term"))
    ranked = stored(_rarest_first(index, lists, "phrase"), "decontam-ranked")
    anchors = stored(ranked.where("rank = 1").select("phrase", "term", "at"), "decontam-anchors")
    first = (index.postings.join(small(anchors, BROADCAST_ROWS), "term")
             .select("doc_id", "th", (F.col("pos") - F.col("at")).alias("start"), "phrase")
             .where("start >= 0").distinct())
    found = stored(first, "decontam-first")
    second = F.col("rank").between(2, RAREST)
    for condition, name in ((second, "decontam-second"), (F.col("rank") > RAREST, "decontam-exact")):
        asked = stored(_asked(ranked, condition), "decontam-asked")
        terms = stored(asked.select("term").distinct(), "decontam-asked-terms")
        postings = index.postings.join(small(terms, BROADCAST_ROWS), "term", "left_semi")
        # Hashes of the texts in question, eight bytes each; another text with such a hash is only looked at in vain.
        texts = stored(found.select("th").distinct(), "decontam-texts")
        if texts.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS:
            postings = postings.join(F.broadcast(texts), "th", "left_semi")
        short = found.join(small(asked.select("phrase").distinct(), BROADCAST_ROWS), "phrase", "left_anti")
        found = stored(_standing(found, small(asked, BROADCAST_ROWS), postings).unionAll(
            short.select("doc_id", "th", "start", "phrase")), name)
    return found


def near_matches(index: PositionalIndex, items: DataFrame, span: int = NEAR_SPAN) -> DataFrame:
    """``(doc_id, th, item)`` where the ``RAREST`` rarest terms of the item that occur in any
    document (all of them if there are fewer) stand within ``span`` words in any order; at
    least ``NEAR_SEEN_PCT`` percent of an item's different terms must occur at all, so an unseen
    or altered word does not hide an item.  ``item`` is the item's words joined by blanks."""
    lists = items.select(F.array_join("words", " ").alias("item"), F.explode(F.array_distinct("words")).alias("term"),
                         F.lit(0).alias("at")).distinct()
    terms = _rarest_first(index, lists, "item", NEAR_SEEN_PCT).where(F.col("rank") <= RAREST).select(
        "item", "term", "rank", F.max("rank").over(Window.partitionBy("item")).alias("n"))
    hits = index.postings.join(small(stored(terms, "decontam-near"), BROADCAST_ROWS), "term")
    so_far = Window.partitionBy("doc_id", "th", "item").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    latest = [F.when(F.col("n") < r, F.col("pos")).otherwise(
        F.last(F.when(F.col("rank") == r, F.col("pos")), ignorenulls=True).over(so_far)) for r in range(1, RAREST + 1)]
    begin = F.when(F.forall(F.array(*latest), lambda x: x.isNotNull()), F.array_min(F.array(*latest)))
    return (hits.withColumn("begin", begin).where(F.col("pos") - F.col("begin") < span)
            .select("doc_id", "th", "item").distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``(doc_id, th, n_words, n_hit, n_items, items, n_near, contaminated)``, one row
    per row of ``docs(doc_id, text)``; ``items`` are the ids as sorted strings."""
    items = stored(items_with_words(benchmark), "decontam-items")
    index = build_index(docs, items)
    phrases = stored(phrases_of(items, width), "decontam-phrases")
    exact = phrase_matches(index, phrases)
    length = F.size(F.split("phrase", " "))
    covered = (exact.select("doc_id", "th", "start", length.alias("len")).distinct()
               .select("doc_id", "th", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos"))
               .distinct().groupBy("doc_id", "th").agg(F.count("*").alias("n_hit")))
    ids = small(stored(phrases.select("phrase", "item_id"), "decontam-ids"), BROADCAST_ROWS)
    named = (exact.select("doc_id", "th", "phrase").distinct().join(ids, "phrase")
             .select("doc_id", "th", F.col("item_id").cast("string").alias("item")).where("item is not null").distinct()
             .groupBy("doc_id", "th").agg(F.array_sort(F.collect_list("item")).alias("items")))
    near = near_matches(index, items).groupBy("doc_id", "th").agg(F.count("*").alias("n_near"))
    out = index.lengths()
    for right in (covered, named, near):
        side = right.withColumnsRenamed({"doc_id": "d", "th": "t"})
        out = out.join(side, out["doc_id"].eqNullSafe(side["d"]) & (out["th"] == side["t"]), "left").drop("d", "t")
    none = F.array().cast("array<string>")
    out = out.select("doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                     F.coalesce("items", none).alias("items"), F.coalesce("n_near", F.lit(0)).alias("n_near"))
    return out.select("*", F.size("items").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    judged = contamination(docs.select("doc_id", "text"), benchmark, width)
    bad = stored(judged.where("contaminated").select("doc_id", "th").distinct(), "decontam-bad")
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (text_hash(docs["text"]) == bad["th"])
    return docs.join(small(bad, BROADCAST_ROWS), same, "left_anti")
