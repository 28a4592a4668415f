"""Backward as-of left join.

For every left row, attach the values of the latest right row with the same
``by`` keys and ``right_time <= left_time`` (NULL when there is none).  As with any
comparison, a NULL time matches nothing: right rows without a time are dropped, left
rows without one get NULLs.

Plan (no range join, no pairs, the same at every size): tag both sides, union them,
and carry the last right value forward along time.  Right rows sort before left rows at
the same time, so a same-day right row is visible.  The carried value is one struct,
so a right row whose value columns are NULL still counts as the latest row.

To keep a hot key from becoming one window task, time is split into buckets
(default: calendar month of the time column):
  1. per (key, bucket): the last right value inside the bucket (an aggregation
     with a map-side partial step);
  2. per key, over that bucket table: the last value of all *earlier* buckets
     (one row per key and bucket, bounded by the calendar);
  3. per (key, bucket) window over the union rows: the last value so far inside
     the bucket, falling back to the carry from step 2.
Every window is partitioned by (key, bucket) or runs over the bucket table.

Where the calendar bounds the rows of a key anyway, ``bucket=None`` leaves out the buckets:
one exchange of both sides and one window per key.  Only left rows with a NULL key, which
match nothing, are still cut by time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_bucket(time_col: str) -> Column:
    return F.trunc(F.col(time_col).cast("date"), "month")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str,
              right_time: str, value_cols: Sequence[str], bucket=month_bucket,
              right_order: Sequence[str] = ()) -> DataFrame:
    """Left rows plus ``value_cols`` of the latest right row at or before left_time.

    ``right_order`` breaks ties among right rows at the same time (later wins).
    """
    by, value_cols, lcols = list(by), list(value_cols), list(left.columns)
    clash = set(value_cols) & set(lcols)
    if clash:
        raise ValueError(f"value columns also on the left side: {sorted(clash)}")
    t = "_asof_t"
    ties = [f"_ro{i}" for i in range(len(right_order))]
    rtypes, ltypes = dict(right.dtypes), dict(left.dtypes)
    # Key and time are shipped once: a left row's own ones are put back from them.
    own = {c: c for c in by if ltypes[c] == rtypes[c]}
    if ltypes[left_time] == rtypes[right_time]:
        own.setdefault(left_time, t)
    rest = [c for c in lcols if c not in own]
    lefts = left.select(*by, F.col(left_time).alias(t), F.lit(1).alias("_kind"),
                        *[F.lit(None).alias(x) for x in ties],
                        F.struct(F.lit(1).alias("_1"), *rest).alias("_left"),
                        F.lit(None).cast(_struct_type(right, value_cols)).alias("_val"))
    rights = right.select(*by, F.col(right_time).alias(t), F.lit(0).alias("_kind"),
                          *[F.col(c).alias(x) for c, x in zip(right_order, ties)],
                          F.lit(None).cast(_struct_type(left, rest, "`_1`:int"))
                          .alias("_left"),
                          F.struct(*value_cols).alias("_val"))
    rights = rights.dropna(subset=[*by, t])  # neither matches anything
    union = lefts.unionByName(rights)
    order = [F.col(t), F.col("_kind"), *[F.col(x).asc_nulls_first() for x in ties]]
    cut = (bucket(t) if bucket is not None else
           F.when(reduce(or_, [F.col(k).isNull() for k in by]), F.col(t)))
    union = union.withColumn("_b", cut)
    so_far = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    last_value = F.last("_val", ignorenulls=True).over(so_far)
    if bucket is None:
        return _lefts(union.withColumn("_v", last_value), lcols, own, value_cols)
    both = union.repartition(*[F.col(k) for k in by], "_b")

    last_right = F.struct(F.col(t).alias("t"), *[F.col(x) for x in ties],
                          F.col("_val").alias("v"))
    # Reading ``_left`` here keeps the columns of both readers of ``both`` alike, so that
    # Spark runs their exchange once and reuses it.
    in_bucket = both.groupBy(*by, "_b").agg(
        F.max(F.when(F.col("_kind") == 0, last_right)).alias("_last"),
        F.count("_left").alias("_lefts")).filter("_lefts >= 0")
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = in_bucket.select(*by, "_b", F.last("_last.v", ignorenulls=True).over(earlier)
                             .alias("_carry"))

    filled = (both.join(carry, on=[*by, "_b"], how="left")
              .withColumn("_v", F.coalesce(last_value, F.col("_carry"))))
    return _lefts(filled, lcols, own, value_cols)


def _lefts(filled: DataFrame, lcols: Sequence[str], own: Mapping[str, str],
           value_cols: Sequence[str]) -> DataFrame:
    """The left rows with their values; ``own``: left columns that stand outside ``_left``."""
    return (filled.filter(F.col("_kind") == 1)
            .select(*[F.col(own[c] if c in own else f"_left.{c}").alias(c) for c in lcols],
                    *[F.col(f"_v.{c}").alias(c) for c in value_cols]))


def _struct_type(df: DataFrame, cols: Sequence[str], first: str = "") -> str:
    types = dict(df.dtypes)
    return "struct<" + ",".join([*([first] if first else []),
                                 *[f"`{c}`:{types[c]}" for c in cols]]) + ">"
