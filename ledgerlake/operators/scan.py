"""Skew-safe running sums and row numbers per key (a two-level prefix scan).

``Window.partitionBy(key).orderBy(t)`` puts every row of a key in one task; a key
holding a third of the data would be a third of the job in one task.  Here the order's
leading column (a date) cuts a key into buckets:

  1. local running sums per (key, bucket)            -- window, parallel per bucket;
  2. totals per (key, bucket)                        -- aggregation over the same exchange;
  3. sums of a key's earlier buckets                  -- window over the totals, whose rows
     per key are bounded by the calendar;
  4. running sum = local + sum of the earlier buckets -- join on (key, bucket).

One lazy plan for every size; nothing is written or sampled.  Keys and buckets are
compared as structs, so NULL keys and NULL buckets form groups of their own (NULL
buckets come last).  Values must be non-NULL (coalesce before passing them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_sums(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column],
                sums: Mapping[str, Column]) -> DataFrame:
    """``df`` plus inclusive running sums per key along (``bucket``, ``order``)."""
    vals = {name: f"_v_{name}" for name in sums}
    at = F.struct(*keys, F.col(bucket).alias("_b")).alias("_kb")
    t = df.select("*", *[c.alias(vals[n]) for n, c in sums.items()], at).repartition("_kb")
    in_bucket = Window.partitionBy("_kb").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    local = t.select("*", *[F.sum(v).over(in_bucket).alias(f"_l_{name}")
                            for name, v in vals.items()])
    # The checksum reads every column, as the window does: the two readers of ``t`` are
    # alike, and Spark runs their exchange once.
    totals = (t.groupBy("_kb").agg(*[F.sum(v).alias(v) for v in vals.values()],
                                   F.bit_xor(F.xxhash64(*t.columns)).alias("_read"))
              .filter(F.col("_read").isNotNull())
              .select("*", F.struct(*[F.col(f"_kb.{k}") for k in keys]).alias("_k")))
    earlier = Window.partitionBy("_k").orderBy(F.col("_kb._b").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_kb").alias("_at"),
                            *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_o_{name}")
                              for name, v in vals.items()])
    joined = local.join(offsets, F.col("_kb") == F.col("_at"))
    return joined.select(*df.columns, *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n)
                                        for n in vals])


def sequence_number(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column],
                    out: str) -> DataFrame:
    """``df`` plus ``out`` = 1, 2, 3 ... per key along (``bucket``, ``order``)."""
    return prefix_sums(df, keys, bucket, order, {out: F.lit(1).cast("long")})
