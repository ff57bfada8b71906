"""Corpus, query and seed readers.

JSONL corpus records carry ``id`` (number or numeric string), ``title`` and
``text``; other keys are ignored.  Malformed lines fail the read (FAILFAST);
blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])

_WS = r"^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$"


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Raw records (id string, title string, text string) plus ``src_file`` and
    ``src_pos`` (position inside the file's read order) for last-wins rules."""
    df = spark.read.schema(CORPUS_SCHEMA).option("mode", "FAILFAST").json(path)
    return df.withColumn("src_file", F.input_file_name()).withColumn("src_pos", F.monotonically_increasing_id())


def with_defaults(df: DataFrame) -> DataFrame:
    """(doc_id, title, text): missing or null id -> -1, title/text -> ''.
    A non-numeric id fails the job (ANSI cast), as it fails the reference."""
    extra = [c for c in df.columns if c not in ("id", "title", "text")]
    return df.select(
        F.coalesce(F.col("id").cast("long"), F.lit(-1).cast("long")).alias("doc_id"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *extra)


def strip(col) -> F.Column:
    """Python ``str.strip()`` for ASCII whitespace."""
    return F.regexp_replace(col, _WS, "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank stripped lines with their 0-based position in read order:
    (line_no long, value string).  Duplicates are kept."""
    from trawl.operators.distribute import ordered_position
    # Within a file, read order is line order (splits of one file keep their
    # offset order); the id is increasing in read order and made dense.
    raw = spark.read.text(path).withColumn("_mid", F.monotonically_increasing_id())
    numbered = ordered_position(raw, [], ["_mid"], out="_n")
    return numbered.select((F.col("_n") - 1).alias("line_no"), strip(F.col("value")).alias("value")).filter(
        F.col("value") != "")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """(qid, query): one query per non-blank line, qid = line position."""
    return read_lines(spark, path).select(F.col("line_no").alias("qid"), F.col("value").alias("query"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """(url): every non-blank line (blank lines are skipped, not an end mark)."""
    return read_lines(spark, path).select(F.col("value").alias("url"))


def dir_size_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row (files, bytes) over all files below ``path``; file contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("length"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def dir_size_mb(spark: SparkSession, path: str) -> DataFrame:
    return dir_size_bytes(spark, path).select(F.floor(F.col("bytes") / F.lit(1048576)).alias("size_mb"))
