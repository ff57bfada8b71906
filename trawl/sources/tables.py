"""Reading Parquet tables.

Spark splits Parquet by row group, so a table of one row group is read -- and then
tokenized or parsed -- by one task however many cores there are.  ``read_parquet`` deals
the rows of a scan that has fewer partitions than the session has cores out over the
cores; a scan with more partitions, as any large table's, is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.parquet(path))
