"""The ``opN_*`` queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import (
    bpe_tree,
    decontam,
    hard_negatives,
    language_id,
    license_templates,
    merkle_audit,
    merkle_manifest,
    mixing,
    pii,
    quality_bands,
    simhash,
    substring_dedup,
    url_reputation,
)
from trawl.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = quality_bands.compression_bands(docs)
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks")


@query
def op3_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicate_classes(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = decontam.contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return r.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


def _span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


@query
def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE))
    return r.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE],
                    F.sha2(_span_list(base), 256).alias("base_sha256"), _span_list(F.col("spans")).alias("spans"))


@query
def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.TARGET_PARTS)


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known outcomes of pages: a page's id is that of the document taken from it, and
    it was bad if that document was labelled toxic or of low quality."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad"))


@query
def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge(pages, page_outcomes(spark, sf_dir)).drop("url")


@query
def op6_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = license_templates.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                    F.round("score", 6).alias("score"))


@query
def op7_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", remainder.alias("part"))
    model = language_id.train(docs.where("part <> 2").select("doc_id", "text", "lang"))
    r = language_id.identify(docs.select("doc_id", "text", "part"), model)
    return r.select("doc_id", F.coalesce(F.col("part") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op8_countmin_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def second_replica(pages: DataFrame) -> DataFrame:
    """A replica to audit, with damage by rule, in proportion at every size, as places go by a
    hash of the page_id (null: none): of 64 pages 8 have another first character, 2 are
    shorter and 2 are lost, which moves what follows, and 1 is there once more."""
    h = F.coalesce(F.conv(F.substring(F.md5(F.col("page_id").cast("string")), 1, 4), 16, 10).cast("int"), F.lit(0))
    html = (F.when(h % 8 == 1, F.concat(F.lit("#"), F.expr("substring(html, 2)")))
            .when(h % 32 == 2, F.expr("substring(html, 3)")).otherwise(F.col("html")))
    again = pages.where(h % 64 == 4).withColumn("url", F.concat(F.coalesce("url", F.lit("")), F.lit("#copy")))
    return pages.where(h % 32 != 3).withColumn("html", html).unionByName(again)


@query
def op10_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return merkle_audit.damage(merkle_audit.archive(pages), merkle_audit.archive(second_replica(pages)))


@query
def op11_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe_tree.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_tree.digests(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda n_chars: merkle_manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"),
                         F.when(altered, leaf(F.col("n_chars") + 1)).alias("tampered"))
    proofs = merkle_manifest.manifest(leaves)
    folded = merkle_manifest.folded_root(F.coalesce("tampered", "leaf"))
    return (proofs.withColumn("folded_root", folded)
            .select("doc_id", "leaf", "subroot", "root",
                    merkle_manifest.proof_digest(F.concat("siblings", "lang_siblings")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


@query
def op13_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select("vec_id", label.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("q"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
