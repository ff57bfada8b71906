"""Tables that grow by micro-batches: a folder ``batch=<n>`` for each, which a retried batch
replaces.  A folder may stand for all earlier ones (``replaces_earlier``): these are then no
longer read; they are left in place, as a reader may still be at work on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_batch(df: DataFrame, path: str, batch_id: int, replaces_earlier: bool = False) -> None:
    """``df`` as the batch's folder; one that replaces earlier ones is known by its name."""
    df.write.mode("overwrite").parquet(f"{path}/{'folded' if replaces_earlier else 'batch'}={int(batch_id)}")


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Batch numbers of the finished folders of one kind."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The rows of all batches, or of those ``before`` one, with ``batch`` (the last column of ``schema``)."""
    ok = [n for n in _numbers(spark, path, "folded") if before is None or n < before]
    start = ok[-1] if ok else -1
    parts = [("folded", start)] * bool(ok) + [("batch", n) for n in _numbers(spark, path, "batch") if n > start and (before is None or n < before)]
    if not parts:
        return spark.createDataFrame([], schema)
    columns = schema.rsplit(",", 1)[0]
    by_batch = [f"{path}/batch={n}" for kind, n in parts if kind == "batch"]
    out = None
    if by_batch:
        out = spark.read.schema(schema).option("basePath", path).parquet(*by_batch)
    if ok:
        folded = spark.read.schema(columns).parquet(f"{path}/folded={start}").withColumn("batch", F.lit(start).cast("long"))
        out = folded if out is None else folded.unionByName(out)
    return out
