"""Run a streaming query over everything available, into a file sink under
the shared scratch location, and read the committed result back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import scratch_path

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, glob: str | None = None, **options) -> DataFrame:
    """A file-source stream of the parquet files at ``path`` (schema taken
    from the files).  ``glob`` selects files inside a directory."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    if glob is not None:
        src = f"{path.rstrip('/')}/{glob}"
    elif path.rstrip("/").endswith(".parquet"):
        # A single file is not a valid stream path; a one-file glob in its
        # directory is.
        head, _, name = path.rstrip("/").rpartition("/")
        src = f"{head}/[{name[0]}]{name[1:]}"
    else:
        src = path
    return reader.parquet(src)


def use_disk_state(spark: SparkSession) -> None:
    """Keep large keyed state (visited URLs) in RocksDB rather than the JVM heap,
    unless the session already chose a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)


def _finish(query, name: str, timeout_s: float | None) -> None:
    """Wait for the end; a stream that is over its time, if one is given, is stopped."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query {name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      timeout_s: float | None = None) -> DataFrame:
    """Process all available input once (``availableNow``), write to a parquet
    sink, and return the committed sink contents as a batch DataFrame."""
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode(output_mode).trigger(availableNow=True).start())
    _finish(q, name, timeout_s)
    return spark.read.schema(df.schema).parquet(out)


def _reports(query) -> list[dict]:
    return [json.loads(p.json) if not isinstance(p, dict) else p for p in query.recentProgress]


def run_to_folder(df: DataFrame, name: str, out: str, checkpoint: str, timeout_s: float | None = None) -> list[dict]:
    """Append all available input to the parquet folder ``out``, going on from ``checkpoint``.
    Returns the progress reports of the run."""
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    _finish(q, name, timeout_s)
    return _reports(q)


def run_foreach_batch(df: DataFrame, name: str, fn, timeout_s: float | None = None, output_mode: str = "append",
                      checkpoint: str | None = None) -> list[dict]:
    """Process all available input once with ``fn(batch_df, batch_id)``; a given ``checkpoint``
    folder lets a later run go on from here.  Returns the progress reports of the run."""
    ckpt = checkpoint or scratch_path(df.sparkSession, f"{name}-ckpt")
    q = (df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    _finish(q, name, timeout_s)
    return _reports(q)


def run_updates(df: DataFrame, name: str, keys: tuple[str, ...], timeout_s: float | None = None) -> DataFrame:
    """Process all available input once in update mode and return the latest row of
    every key.  Each batch's changed rows are a partition of their own, which a
    retried batch overwrites."""
    spark = df.sparkSession
    out = scratch_path(spark, f"{name}-updates")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(out))

    write(spark.createDataFrame([], df.schema), 0)
    run_foreach_batch(df, name, write, timeout_s, "update")
    others = [c for c in df.columns if c not in keys]
    updates = spark.read.schema(df.schema.add("_batch", "long")).parquet(out)
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("_batch")).alias("_v"))
    return last.select(*keys, "_v.*")
