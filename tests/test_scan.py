"""Skew-safe prefix scan against a plain window, with a hot key and NULL keys and buckets."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.scan import prefix_sums, sequence_number


def test_prefix_sums_equal_window_sums(spark):
    rnd = random.Random(3)
    rows = [("HOT", i, rnd.randint(-5, 9)) for i in range(3000)]          # one key, most rows
    rows += [(f"k{j % 37}", i, rnd.randint(-5, 9)) for j, i in enumerate(range(900))]
    rows += [(None, i, 1) for i in range(50)]                                # NULL key groups
    df = spark.createDataFrame(rows, "k string, t int, v int").withColumn(
        "day", F.when(F.col("t") < 2800, F.floor(F.col("t") / 100)))         # last days NULL
    order = [F.col("t").asc()]
    got = prefix_sums(df, ["k"], "day", order,
                      {"s": F.col("v").cast("long"), "n": F.lit(1).cast("long")})
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", "v", "day", F.sum("v").over(w).cast("long").alias("s"),
                     F.count(F.lit(1)).over(w).cast("long").alias("n"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    numbered = sequence_number(df, ["k"], "day", order, "rn")
    hot = numbered.filter(F.col("k") == "HOT").agg(F.min("rn"), F.max("rn"),
                                                    F.countDistinct("rn")).collect()[0]
    assert tuple(hot) == (1, 3000, 3000)
