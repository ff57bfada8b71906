"""Incremental indexing.  Every micro-batch of documents is indexed on its
own and written as partial ``part_no = batch_id`` with its length rows; a retried batch
overwrites its own partition only (dynamic partition overwrite), so the parts are
idempotent.  ``merged_index`` folds the parts into an index that can be written and
searched, the later part winning per (term, doc_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.index import (
    DEFAULT_STOPWORDS,
    LENGTH_TERM,
    Index,
    doc_terms,
    index_from_combined,
    merge_partials,
    postings_with_lengths,
)


def partial_writer(parts_dir: str, stopwords=DEFAULT_STOPWORDS, id_col: str = "doc_id",
                   title_col: str | None = "title", text_col: str = "text", stem: bool = False):
    def write(batch: DataFrame, batch_id: int) -> None:
        post = postings_with_lengths(doc_terms(batch, id_col, title_col, text_col, stopwords, stem))
        (post.withColumn("part_no", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("part_no").parquet(parts_dir))
    return write


def merged_index(spark: SparkSession, parts_dir: str, stopwords=DEFAULT_STOPWORDS, stem: bool = False) -> Index:
    """The index over all parts; ``stopwords`` and ``stem`` as the parts were written with."""
    return index_from_combined(merge_partials(spark.read.parquet(parts_dir)), stem, stopwords)


def merge(spark: SparkSession, parts_dir: str) -> DataFrame:
    """(term, doc_id, tf, dl) merged over all parts."""
    return merge_partials(spark.read.parquet(parts_dir)).filter(F.col("term") != LENGTH_TERM)
