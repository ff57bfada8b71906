"""The rotating page store: gzip JSON lines, at most ``per_file`` records per
file, target directory overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


PAGE_SCHEMA = "page_id long, url string, status int, headers map<string,string>, html string"


def with_response(pages: DataFrame, status: int = 200, headers: dict[str, str] | None = None) -> DataFrame:
    """Pages as stored records: response status and headers added where they are missing."""
    out = pages
    if "status" not in out.columns:
        out = out.withColumn("status", F.lit(status))
    if "headers" not in out.columns:
        pairs = [F.lit(x) for kv in (headers or {"Content-Type": "text/html"}).items() for x in kv]
        out = out.withColumn("headers", F.create_map(*pairs))
    return out.select("page_id", "url", "status", "headers", "html")


def write_pages(pages: DataFrame, path: str, per_file: int = 1000) -> None:
    (pages.write.mode("overwrite").option("maxRecordsPerFile", per_file)
     .option("compression", "gzip").json(path))


def read_pages(spark: SparkSession, path: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def records_per_file(spark: SparkSession, path: str) -> DataFrame:
    """(file, records) of a page store."""
    return read_pages(spark, path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("records"))
