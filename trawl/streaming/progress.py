"""Running crawl progress -- fetches per event-time window.

``progress_windows`` has no watermark: a row counts however late its file comes, and the
newest window is reported too.  The state is one row per window.  Run it with
``runner.run_updates``, which keeps the latest count of every window.

``Progress`` is for streams without end: a window is written once, when the watermark has
passed its end, and its state goes.  Rows that come later are not lost but written beside, to
be counted or added by hand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.streaming.store import read_batches, write_batch

KEYS = ("window_start", "window_end")


def progress_windows(fetches: DataFrame, ts_col: str = "ts", window: str = "1 hour") -> DataFrame:
    """(window_start, window_end, fetches), to be written in update mode."""
    timed = fetches.select(F.col(ts_col).cast("timestamp").alias("_ts"))
    agg = timed.groupBy(F.window("_ts", window).alias("w")).agg(F.count(F.lit(1)).alias("fetches"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "fetches")


WINDOWS = "window_start timestamp, window_end timestamp, fetches long"
MARKS = "latest timestamp, batch long"


@dataclass(frozen=True)
class Progress:
    """Closed windows (``windows``) and late rows (``late/batch=*``) below ``path``; each run goes on
    from the one before.  Both sides read the same files in the same order, and a batch's
    watermark is ``delay`` behind the latest time of the batches before."""

    path: str
    window: str = "1 hour"
    delay: str = "2 hours"

    def windows(self, spark: SparkSession) -> DataFrame:
        """(window_start, window_end, fetches) of the closed windows."""
        return spark.read.schema(WINDOWS).parquet(f"{self.path}/windows")

    def late(self, spark: SparkSession) -> DataFrame:
        """(ts, window_start, window_end, batch) of the rows that came after their window was closed."""
        return read_batches(spark, f"{self.path}/late", "ts timestamp, window_start timestamp, window_end timestamp, batch long")

    def run(self, fetches: DataFrame, ts_col: str = "ts") -> list[dict]:
        """Take in all of the stream ``fetches`` that is available now.  Returns the progress
        reports of the counting side, which tell the rows of state."""
        from trawl.streaming import runner
        spark = fetches.sparkSession
        timed = fetches.select(F.col(ts_col).cast("timestamp").alias("ts"))

        def side(batch: DataFrame, batch_id: int) -> None:
            marks = read_batches(spark, f"{self.path}/marks", MARKS, batch_id)
            latest = marks.agg(F.max("latest")).select((F.col("max(latest)") - F.expr(f"INTERVAL {self.delay}")).alias("mark"))
            placed = batch.filter(F.col("ts").isNotNull()).withColumn("w", F.window("ts", self.window))
            late = placed.crossJoin(F.broadcast(latest)).filter(F.col("w.end") <= F.col("mark"))  # one row
            write_batch(late.select("ts", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")), f"{self.path}/late", batch_id)
            write_batch(batch.agg(F.max("ts").alias("latest")), f"{self.path}/marks", batch_id)

        runner.run_foreach_batch(timed, "late", side, checkpoint=f"{self.path}/late-checkpoint")
        counted = timed.withWatermark("ts", self.delay).groupBy(F.window("ts", self.window).alias("w")).agg(F.count(F.lit(1)).alias("fetches"))
        closed = counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "fetches")
        return runner.run_to_folder(closed, "closed", f"{self.path}/windows", f"{self.path}/checkpoint")
