"""Distribution helpers shared by the operators.

* ``broadcast_if_small``: broadcast a join side only after its row count has
  been checked against a bound; beyond the bound the plan keeps a shuffle join
  (which AQE may still turn into a broadcast from runtime statistics).
* ``ordered_position``: the 1-based position of every row inside its group in a
  given order -- a skew-safe ``row_number``.  A plain window puts a whole group
  into one task; here the rows are range-partitioned on (group, order), so a
  group holding a third of all rows is spread over many tasks, and the
  positions are stitched together from per-(partition, group) counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a join side we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000

_PID_SHIFT = 33  # monotonically_increasing_id = partition index << 33 | row index


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    The check runs ``df.limit(max_rows + 1).count()``, which stops reading
    once the bound is passed."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def ordered_position(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                     out: str = "pos", checkpoint: bool = True) -> DataFrame:
    """Add ``out`` = row_number() over (partition by group order by order).

    ``order`` must make the order total (end it with a unique column).  The
    range-partitioned, numbered rows are checkpointed (reliable checkpoint in
    ``spark.checkpoint.dir``) so both uses below read identical partition
    numbering even if executors are lost and tasks rerun.
    """
    group = list(group)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    sort_keys = [F.col(g) for g in group] + order_cols
    numbered = (
        df.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _PID_SHIFT))
    )
    if checkpoint:
        numbered = numbered.checkpoint(eager=True)
    # One row per (partition, group): where the group starts in the partition
    # and how many of its rows precede this partition.
    spans = numbered.groupBy("_pid", *group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if not group:
        # One row per partition: bounded by the partition count.
        spans = F.broadcast(spans)
    else:
        # One row per (partition, group): broadcast when its count allows, so
        # the numbered rows are not shuffled a second time.
        spans = broadcast_if_small(spans, DEFAULT_BROADCAST_ROWS // 2)
    # Null-safe on the group keys: a null group is a group like any other.
    renamed = spans.select(F.col("_pid").alias("_spid"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                           "_first", "_before")
    cond = [numbered["_pid"] == renamed["_spid"]] + [
        numbered[g].eqNullSafe(renamed[f"_g{i}"]) for i, g in enumerate(group)]
    out_df = numbered.join(renamed, on=cond, how="inner")
    return out_df.withColumn(out, F.col("_mid") - F.col("_first") + F.col("_before") + F.lit(1)).drop(
        "_mid", "_pid", "_spid", "_first", "_before", *[f"_g{i}" for i in range(len(group))])
