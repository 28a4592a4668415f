"""Presentation order of each gold mart (O1, O2).

Sorting is for display and export only: the models themselves are unordered, so
no global sort runs in the middle of a pipeline.  NULLs sort last in both
directions, as in the models' SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The ORDER BY of each mart.
ORDER = {
    "monthly_spending": [("month", "asc"), ("total_spent", "desc")],
    "position_lots": [("symbol", "asc"), ("source", "asc"), ("trade_date", "asc")],
    "realized_gains": [("trade_date", "asc")],
    "unrealized_gains": [("unrealized_gain", "desc")],
    "investment_growth": [("total_gain", "desc")],
    "wealth_summary": [("as_of_date", "asc")],
}


def sort_keys(name: str) -> list[Column]:
    if name == "portfolio_roe_summary":
        return [F.when(F.col("source") == "ALL", 0).otherwise(1), F.col("source").asc_nulls_last()]
    return [F.col(c).asc_nulls_last() if d == "asc" else F.col(c).desc_nulls_last()
            for c, d in ORDER[name]]


def present(name: str, df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """``df`` in the mart's order; ``ties`` settle the order of equal rows."""
    return df.orderBy(*sort_keys(name), *[F.col(c).asc_nulls_last() for c in ties])


def ranked(name: str, df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """``df`` with its place in the mart's order, from 1.

    For marts with a row per month, day or source: the window has no partition.
    """
    order = Window.orderBy(*sort_keys(name), *[F.col(c).asc_nulls_last() for c in ties])
    return df.withColumn("place", F.row_number().over(order).cast("long"))


def placed(name: str, df: DataFrame, lead: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """``df`` with its place in the mart's order, from 1, for marts with a row per trade.

    ``lead``: the first columns of the order.  Rows are numbered per value of these, and the
    values' offsets are running counts over one row per value, so no task sees all rows.
    """
    order = [*sort_keys(name), *[F.col(c).asc_nulls_last() for c in ties]]
    key = F.struct(*lead)
    rows = df.withColumn("_k", key)
    inner = F.row_number().over(Window.partitionBy("_k").orderBy(*order))
    sizes = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    first = [F.col(f"_k.{c}").asc_nulls_last() for c in lead]
    before = F.sum("_n").over(Window.orderBy(*first).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(F.col("_k").alias("_at"), F.coalesce(before, F.lit(0)).alias("_o"))
    return (rows.withColumn("_i", inner).join(offsets, F.col("_k") == F.col("_at"))
            .select(*df.columns, (F.col("_i") + F.col("_o")).cast("long").alias("place")))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a batch, as printed before a write (O3)."""
    return df.limit(n)
