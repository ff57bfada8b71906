"""The skew-safe position equals a plain row_number, also when one group
holds a third of all rows and when group keys are null."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trawl.operators.distribute import ordered_position


def test_ordered_position_skewed(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        (F.rand(3) * 1000).cast("int").alias("o"), F.col("id"))
    got = ordered_position(df.repartition(16), ["g"], ["o", "id"])
    w = Window.partitionBy("g").orderBy("o", "id")
    exp = df.withColumn("pos", F.row_number().over(w))
    assert got.count() == n
    assert got.select("g", "o", "id", "pos").exceptAll(exp.select("g", "o", "id", "pos")).count() == 0


def test_ordered_position_global(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    got = ordered_position(df.repartition(8), [], ["v"])
    assert sorted((r.v, r.pos) for r in got.collect()) == [(i, i + 1) for i in range(5000)]


def test_first_n_large_budget_equals_top_n(spark):
    from trawl.operators.crawlplan import MAX_TOP_N, first_n
    df = spark.range(40000).select((F.col("id") * 7 % 40000).alias("ts"), F.col("id").alias("event_id"))
    n = MAX_TOP_N + 123
    got = sorted(tuple(r) for r in first_n(df.repartition(8), n, ["ts", "event_id"]).collect())
    exp = sorted(tuple(r) for r in df.orderBy("ts", "event_id").limit(n).collect())
    assert got == exp
