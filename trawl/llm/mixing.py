"""Mixing sources to target weights by Pfair scheduling.

A source with ``parts`` of ``Q`` in all has the weight ``parts / Q``.  Its k-th block
(from 0) may go out from slot ``floor(k * Q / parts)`` on and must before slot
``ceil((k + 1) * Q / parts)``; each slot takes the released block with the earliest
deadline (then the smaller source number).  As the weights add up to one, every
deadline holds, so after any number of slots a source has had its share up to less
than one block.  The schedule repeats every ``Q`` slots; only one period, whose size
the weights give, is worked out, as a fold over its slots in one small row.  Which
period and place a row belongs to follows from its rank in its source, and its
position in the mix from the schedule's running counts.

Ranks.  Within a source rows are ordered by the MD5 of their doc_id.  Its leading bits
cut each source into buckets of about ``BUCKET_ROWS`` rows, a hot source into more;
bucket counts are added up in two levels, and only the rows of a bucket are sorted
together.

Defined results: sources without a target weight, null among them, share one class
with ``rest`` parts; when a source has run out, its slots are left out and the others
go on in schedule order, so all rows come out, once each; null doc_ids order as the
empty string; rows that are equal get neighbouring places; an empty table gives an
empty result; the columns block, slot and position replace any of these names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_ROWS = 32
BUCKET_ROWS = 512
GROUP_BUCKETS = 1024

#: Production weights of the sources of ``documents``, in parts.
TARGET_PARTS: dict[str, int] = {
    "src0": 12, "src1": 8, "src2": 8, "src3": 6, "src4": 6, "src5": 5, "src6": 5, "src7": 5, "src8": 5, "src9": 5,
    "src10": 4, "src11": 4, "src12": 4, "src13": 4, "src14": 4, "src15": 3, "src16": 3, "src17": 3, "src18": 3, "src19": 2,
}
REST_PARTS = 1


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def period(spark: SparkSession, parts: list[int]) -> DataFrame:
    """``(g, k, t, before)``: block ``k`` of class ``g`` goes to slot ``t`` of the
    period; ``before`` has every class' blocks in the slots below ``t``."""
    total = sum(parts)
    zero = F.struct(_longs([0] * len(parts)).alias("done"),
                    F.array().cast("array<struct<g:int,k:bigint,t:bigint,before:array<bigint>>>").alias("out"))
    weights = _longs(parts)

    def step(acc: Column, t: Column) -> Column:
        waiting = F.filter(F.transform(weights, lambda q, i: F.struct(
            (-F.floor(-(acc["done"][i] + 1) * total / q)).alias("deadline"), i.alias("g"),
            (F.floor(acc["done"][i] * total / q) <= t).alias("released"))), lambda x: x["released"])
        g = F.array_min(waiting)["g"]
        entry = F.struct(g.alias("g"), acc["done"][g].alias("k"), t.alias("t"), acc["done"].alias("before"))
        done = F.transform(acc["done"], lambda d, i: d + (i == g).cast("long"))
        return F.struct(done.alias("done"), F.concat(acc["out"], F.array(entry)).alias("out"))

    slots = F.sequence(F.lit(0).cast("long"), F.lit(total - 1).cast("long"))
    return spark.range(1).select(F.inline(F.aggregate(slots, zero, step, lambda acc: acc["out"])))


def _ranked(docs: DataFrame, group: Column, sizes: list[int]) -> DataFrame:
    """``docs`` with ``g`` and ``rank``, the place in the class by the MD5 of the doc_id."""
    buckets = _longs([max(1, -(-n // BUCKET_ROWS)) for n in sizes])
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    lead = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    placed = (docs.withColumn("g", group).withColumn("digest", digest)
              .withColumn("bucket", F.shiftright(lead * buckets[F.col("g")], 32)))
    sized = (placed.groupBy("g", "bucket").agg(F.count("*").alias("n"))
             .withColumn("hi", F.floor(F.col("bucket") / GROUP_BUCKETS)))
    above = Window.partitionBy("g").orderBy("hi").rowsBetween(Window.unboundedPreceding, -1)
    beside = Window.partitionBy("g", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = sized.groupBy("g", "hi").agg(F.sum("n").alias("n")).select(
        "g", "hi", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
    starts = sized.join(groups, ["g", "hi"]).select(
        "g", "bucket", (F.col("above") + F.coalesce(F.sum("n").over(beside), F.lit(0))).alias("first"))
    inside = Window.partitionBy("g", "bucket").orderBy("digest", "doc_id", "source", "tie")
    tie = F.xxhash64(*[docs[c] for c in docs.columns])
    ranked = placed.withColumn("tie", tie).withColumn("r", F.row_number().over(inside) - 1)
    return (ranked.join(starts, ["g", "bucket"]).withColumn("rank", F.col("first") + F.col("r"))
            .drop("digest", "bucket", "tie", "r", "first"))


def mix(docs: DataFrame, targets: Mapping[str, int], rest: int = REST_PARTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` (with doc_id and source) and ``block`` (of its source), ``slot`` (of
    the schedule) and ``position`` (in the mix, from 0, without gaps)."""
    names = sorted(targets)
    parts = [targets[n] for n in names] + [rest]
    if min(parts) < 1:
        raise ValueError("every class needs a positive weight")
    total = sum(parts)
    docs = docs.drop("block", "slot", "position")
    carried = docs.columns
    work = docs.select(F.struct(*[docs[c] for c in carried]).alias("row"), docs["doc_id"], docs["source"])
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    group = F.coalesce(F.when(F.col("source").isNotNull(), F.try_element_at(number, F.col("source"))), F.lit(len(names)))
    counted = {r.g: r.n for r in docs.select(group.alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect()}
    sizes = [counted.get(g, 0) for g in range(len(parts))]

    block = F.floor(F.col("rank") / block_rows)
    own = _longs(parts)[F.col("g")]
    placed = (_ranked(work, group, sizes).withColumn("block", block)
              .withColumn("k", F.col("block") % own).withColumn("cycle", F.floor(F.col("block") / own)))
    # The period has as many rows as the weights have parts: its size does not depend on the data.
    timed = placed.join(F.broadcast(period(docs.sparkSession, parts)), ["g", "k"])
    gone = F.zip_with(F.zip_with("before", _longs(parts), lambda b, q: (F.col("cycle") * q + b) * block_rows),
                      _longs(sizes), lambda a, n: F.least(a, n))
    position = F.aggregate(gone, F.lit(0).cast("long"), lambda a, x: a + x) + F.col("rank") % block_rows
    return timed.select("row.*", "block", (F.col("cycle") * total + F.col("t")).alias("slot"), position.alias("position"))
