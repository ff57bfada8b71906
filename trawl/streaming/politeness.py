"""C9 over rounds: the fetch plan of a stream of URLs, with the last request of every
domain carried along.

``DomainClock`` keeps, below ``path``, the time of the last planned request of each domain,
a folder for every batch with the domains it touched.  A batch of URLs is spaced by
``fetch_plan`` (which numbers a domain over many tasks, however large it is) from what is
left of the delay since that time, and becomes ``plan/batch=*`` with absolute times; the clock
then moves on.  State: one row a domain, and a domain whose delay has long passed is
forgotten when the folders are folded together.  ``due`` gives the URLs whose time has come."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.crawlplan import DEFAULT_DELAY, fetch_plan
from trawl.streaming.store import read_batches, write_batch

PLAN_SCHEMA = "domain string, url string, pos long, at_s double, batch long"
CLOCK_SCHEMA = "domain string, last_s double, delay double, batch long"
# So many batches' folders of the clock are folded into one.
FOLD_BATCHES = 16


@dataclass(frozen=True)
class DomainClock:
    path: str
    default_delay: float = DEFAULT_DELAY

    def last_requests(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """(domain, last_s, delay) over all batches, or those ``before`` one."""
        rows = read_batches(spark, f"{self.path}/clock", CLOCK_SCHEMA, before)
        return rows.groupBy("domain").agg(F.max("last_s").alias("last_s"), F.max_by("delay", "batch").alias("delay"))

    def plan(self, spark: SparkSession) -> DataFrame:
        """(domain, url, pos, at_s, batch) of all batches."""
        return read_batches(spark, f"{self.path}/plan", PLAN_SCHEMA)

    def due(self, spark: SparkSession, after_s: float, upto_s: float) -> DataFrame:
        """(domain, url, at_s) of the requests planned after ``after_s`` and up to ``upto_s``."""
        return self.plan(spark).filter((F.col("at_s") > after_s) & (F.col("at_s") <= upto_s)).select("domain", "url", "at_s")

    def add(self, allowed: DataFrame, batch_id: int, now_s: float) -> DataFrame:
        """Plan a batch ``allowed(domain, url, prio, delay)`` that is there at ``now_s`` (seconds).  A
        batch that is run again is planned as the first time."""
        spark = allowed.sparkSession
        ages = self.last_requests(spark, batch_id).select("domain", (F.lit(now_s) - F.col("last_s")).alias("age_s"))
        timed = fetch_plan(allowed, self.default_delay, last_requests=ages).select(
            "domain", "url", "pos", F.round(F.lit(now_s) + F.col("start_s"), 6).alias("at_s"))
        write_batch(timed, f"{self.path}/plan", batch_id)
        planned = self.plan(spark).filter(F.col("batch") == batch_id)
        delays = allowed.groupBy("domain").agg(F.max("delay").alias("delay"))
        clock = planned.groupBy("domain").agg(F.max("at_s").alias("last_s"))
        write_batch(clock.join(delays, clock["domain"].eqNullSafe(delays["domain"])).select(clock["domain"], "last_s", "delay"),
                    f"{self.path}/clock", batch_id)
        if batch_id % FOLD_BATCHES == FOLD_BATCHES - 1:
            self._fold(spark, batch_id, now_s)
        return planned

    def _fold(self, spark: SparkSession, batch_id: int, now_s: float) -> None:
        """All folders up to this batch as one, without the domains that may be asked again at once."""
        wait = F.greatest(F.coalesce("delay", F.lit(0.0)), F.lit(self.default_delay))
        live = self.last_requests(spark).filter(F.col("last_s") + wait > now_s)
        write_batch(live, f"{self.path}/clock", batch_id, replaces_earlier=True)


def plan_stream(allowed_stream: DataFrame, path: str, default_delay: float = DEFAULT_DELAY) -> None:
    """Plan all URLs of ``allowed_stream(domain, url, prio, delay, now_s)`` that are available now;
    a batch's time is the latest ``now_s`` in it.  The next run goes on from here."""
    from trawl.streaming import runner
    clock = DomainClock(path, default_delay)

    def plan(batch: DataFrame, batch_id: int) -> None:
        now_s = batch.agg(F.max("now_s")).first()[0]
        if now_s is not None:
            clock.add(batch.drop("now_s"), batch_id, float(now_s))

    runner.run_foreach_batch(allowed_stream, "politeness", plan, checkpoint=f"{path}/checkpoint")
