"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words of ASCII letters, digits and anything above ASCII.
ALNUM_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Byte table: A-Z lower-cased, every byte of ``ALNUM_GAP`` (after that) a blank.
ALNUM_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all other letters unchanged.  Pure ASCII texts take the
    fast path of ``lower``; it gives the same there."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``_name``, ``__name``, ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (a stored table) marked for broadcast if it has at most ``rows`` rows.
    Beyond that Spark joins it by a shuffle; the result is the same."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
