"""Visited de-duplication on a stream of crawled pages: every link target is emitted
once, the first time it is seen.

``new_link_targets`` keeps every URL in the stream's state, for streams that end.
``first_seen`` is for streams that do not: the state holds the URLs of the last ``horizon``
of event time only (``dropDuplicatesWithinWatermark``), and what it lets through is checked
against ``Visited``, the table of all URLs met so far.  A bitmap of URL hashes stands before
that table: a URL whose bit is not set is new without a look, only the others (seen ones,
and the few that share a bit) are anti-joined.  The bitmap is a row for each 32,768 bits, made
and merged by Spark's bitmap aggregates, so a batch reads and adds the buckets it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.pages import link_edges
from trawl.streaming.store import read_batches, write_batch

# Bits of the URL bitmap: at most 256 MB of buckets, one wrong look in 200 at ten million URLs.
BITS = 1 << 31
URLS_SCHEMA = "url string, batch long"
BITS_SCHEMA = "bucket long, bits binary, batch long"


def new_link_targets(pages_stream: DataFrame) -> DataFrame:
    """(url) of link targets never seen before in the stream."""
    edges = link_edges(pages_stream)
    return edges.select(F.col("dst_url").alias("url")).dropDuplicates(["url"])


def recent_link_targets(pages_stream: DataFrame, horizon: str, ts_col: str | None = None) -> DataFrame:
    """(url, ts) of link targets not seen within ``horizon``.  A URL's state goes when the watermark
    has passed its first sight by that much.  Time is that of arrival, so no page is late;
    with an event time in ``ts_col``, pages behind the watermark are left out."""
    ts = F.current_timestamp() if ts_col is None else F.col(ts_col).cast("timestamp")
    timed = pages_stream.withColumn("_ts", ts).withWatermark("_ts", horizon)
    edges = link_edges(timed, keep=("_ts",))
    return edges.select(F.col("dst_url").alias("url"), F.col("_ts").alias("ts")).dropDuplicatesWithinWatermark(["url"])


def _place(bits: int) -> Column:
    # Bucket and position are counted from 1 up.
    return F.pmod(F.xxhash64("url"), F.lit(bits)) + 1


def _is_set() -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.expr("int(position div 8) + 1"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (F.col("position") % 8).cast("int")) % 2 == 1


@dataclass(frozen=True)
class Visited:
    """All URLs met so far, below ``path``: ``urls/batch=*`` and ``bits/batch=*``.  A batch that is
    run again replaces its own folders and is judged against earlier batches only."""

    path: str
    bits: int = BITS

    def urls(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """(url, batch) of all batches, or those ``before`` one."""
        return read_batches(spark, f"{self.path}/urls", URLS_SCHEMA, before)

    def bitmap(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """(bucket, bits) merged over all batches, or those ``before`` one."""
        return read_batches(spark, f"{self.path}/bits", BITS_SCHEMA, before).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def add(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(url) of the batch's URLs that no earlier batch had; they are kept."""
        spark = batch.sparkSession
        asked = batch.select("url").distinct()
        placed = asked.withColumn("_at", _place(self.bits)).select(
            "url", F.bitmap_bucket_number("_at").alias("bucket"), F.bitmap_bit_position("_at").alias("position"))
        known = placed.join(self.bitmap(spark, batch_id), "bucket", "left").withColumn("maybe", F.coalesce(_is_set(), F.lit(False)))
        from trawl.operators.rank import _written
        known = _written(known.select("url", "bucket", "position", "maybe"), "asked-urls")
        earlier = self.urls(spark, batch_id).select("url")
        fresh = known.filter("not maybe").unionByName(known.filter("maybe").join(earlier, "url", "left_anti"))
        write_batch(fresh.select("url"), f"{self.path}/urls", batch_id)
        added = self.urls(spark).filter(F.col("batch") == batch_id)
        at = added.withColumn("_at", _place(self.bits))
        write_batch(at.groupBy(F.bitmap_bucket_number("_at").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits")), f"{self.path}/bits", batch_id)
        return added.select("url")


def first_seen(pages_stream: DataFrame, path: str, horizon: str = "1 hour", ts_col: str | None = None, bits: int = BITS) -> list[dict]:
    """Add the link targets of all pages that are available now to ``Visited(path)``, each under
    the micro-batch that met it first, and go on from there next time.  Returns the
    progress reports, which tell the rows of state."""
    from trawl.streaming import runner
    visited = Visited(path, bits)
    runner.use_disk_state(pages_stream.sparkSession)

    def keep(batch: DataFrame, batch_id: int) -> None:
        visited.add(batch, batch_id)

    return runner.run_foreach_batch(recent_link_targets(pages_stream, horizon, ts_col), "first-seen", keep, checkpoint=f"{path}/checkpoint")
