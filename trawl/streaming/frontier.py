"""C7 + C8 over rounds: a frontier that is kept, added to and taken from.

Below ``path``: ``seen`` (``Visited``: every URL the frontier has met, with its bitmap),
``added`` and ``gone`` (URLs that entered it, and that were taken from it or fetched), each a
folder for every round, its files sorted by priority.  A round adds the links of its new
pages only, so its cost follows these; ``take`` reads the priorities that surely hold enough
URLs, by the counts kept of each round and band of priorities: a filter on a sorted
column, which Parquet's statistics answer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.crawlplan import FRONTIER_SIZE, first_n
from trawl.streaming.dedup import BITS, Visited
from trawl.streaming.store import read_batches, write_batch

URLS = "url string, prio string, batch long"
COUNTS = "band string, n long, batch long"


@dataclass(frozen=True)
class Frontier:
    path: str
    bits: int = BITS

    def _table(self, spark: SparkSession, name: str, before: int | None = None) -> DataFrame:
        return read_batches(spark, f"{self.path}/{name}", URLS, before)

    def _put(self, urls: DataFrame, name: str, round_no: int) -> DataFrame:
        """Write a round's URLs and how many each band has."""
        spark = urls.sparkSession
        sorted_urls = urls.select("url", F.md5("url").alias("prio")).repartitionByRange("prio", "url").sortWithinPartitions("prio", "url")
        write_batch(sorted_urls, f"{self.path}/{name}", round_no)
        rows = self._table(spark, name).filter(F.col("batch") == round_no)
        write_batch(rows.groupBy(F.substring("prio", 1, 2).alias("band")).agg(F.count(F.lit(1)).alias("n")), f"{self.path}/{name}-counts", round_no)
        return rows

    def add(self, candidates: DataFrame, round_no: int, visited: DataFrame | None = None) -> DataFrame:
        """(url) of the ``candidates(url)`` that enter: never met before and not ``visited(url)``, the
        pages fetched since the last round, which also leave the frontier if they are in it."""
        spark = candidates.sparkSession
        fetched = candidates.select("url").limit(0) if visited is None else visited.select("url").distinct()
        wanted = candidates.select("url").distinct().join(fetched, "url", "left_anti")
        seen = Visited(f"{self.path}/seen", self.bits)
        met = seen.add(wanted.select("url", F.lit(True).alias("new")).unionByName(fetched.select("url", F.lit(False).alias("new"))), round_no)
        self._put(met.join(fetched, "url", "left_anti"), "added", round_no)
        self._put(fetched, "gone", 2 * round_no)
        return self._table(spark, "added").filter(F.col("batch") == round_no).select("url")

    def waiting(self, spark: SparkSession) -> DataFrame:
        """(url, prio) of the frontier as it stands."""
        return self._table(spark, "added").join(self._table(spark, "gone").select("url"), "url", "left_anti").select("url", "prio")

    def _bands(self, spark: SparkSession, n: int) -> str | None:
        """The last of the lowest bands that surely hold ``n`` waiting URLs; None for all."""
        count = lambda name, sign: read_batches(spark, f"{self.path}/{name}-counts", COUNTS).select("band", (F.col("n") * sign).alias("n"))
        left = 0
        for row in count("added", 1).unionByName(count("gone", -1)).groupBy("band").agg(F.sum("n").alias("n")).orderBy("band").collect():
            left += max(row.n, 0)
            if left >= n:
                return row.band
        return None

    def take(self, round_no: int, size: int = FRONTIER_SIZE) -> DataFrame:
        """(url, prio) of the first ``size`` waiting URLs, which leave the frontier."""
        spark = SparkSession.active()
        upto = self._bands(spark, size)
        near = lambda df: df if upto is None else df.filter(F.col("prio") < upto + "g")  # noqa: E731 (hex digits end before g)
        gone = near(self._table(spark, "gone", 2 * round_no + 1))
        waiting = near(self._table(spark, "added", round_no + 1)).join(gone.select("url"), "url", "left_anti")
        rows = self._put(first_n(waiting.select("url", "prio"), size, ["prio", "url"]).select("url"), "gone", 2 * round_no + 1)
        return rows.select("url", "prio")
