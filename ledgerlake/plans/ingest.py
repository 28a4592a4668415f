"""Price-ingest planning jobs (G5, G6, J8) and write previews."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Market time zone of "today" and the default refresh window.
MARKET_TZ = "America/New_York"
DEFAULT_BACKFILL_DAYS = 5


def watchlist_symbols(lines: DataFrame, col: str = "value") -> DataFrame:
    """Watchlist text (one symbol per line): trimmed, upper-cased, blanks and
    '#' comments skipped (S9)."""
    s = F.trim(F.col(col))
    return (lines.filter((s != "") & ~s.startswith("#"))
            .select(F.upper(s).alias("symbol")).distinct())


def ticker_universe(trades: DataFrame, watchlist: DataFrame | None = None,
                    extra: Iterable[str] = ()) -> DataFrame:
    """Distinct symbols to price: traded ∪ watchlist ∪ extra.

    Traded symbols keep their case; watchlist and extra entries are upper-cased.
    NULL and empty traded symbols are skipped.
    """
    spark = trades.sparkSession
    traded = (trades.select(F.col("symbol"))
              .filter(F.col("symbol").isNotNull() & (F.col("symbol") != "")))
    out = traded
    if watchlist is not None:
        out = out.union(watchlist.select("symbol"))
    extras = sorted({e.strip().upper() for e in extra if e and e.strip()})
    if extras:
        out = out.union(spark.createDataFrame([(e,) for e in extras], "symbol string"))
    return out.distinct()


def market_today(tz: str = MARKET_TZ):
    return F.to_date(F.from_utc_timestamp(F.current_timestamp(), tz))


def backfill_window(trades: DataFrame, end: dt.date | str | None = None, backfill: bool = False,
                    days: int = DEFAULT_BACKFILL_DAYS, start: dt.date | str | None = None
                    ) -> DataFrame:
    """One row (start_date, end_date) of the price refresh.

    end defaults to today in the market's zone.  start is the given one, else with
    ``backfill`` the earliest trade date (NULL when there are no trades), else end - days.
    """
    end_col = F.to_date(F.lit(str(end))) if end is not None else market_today()
    if start is not None:
        return trades.sparkSession.range(1).select(F.to_date(F.lit(str(start))).alias("start_date"),
                                                   end_col.alias("end_date"))
    if backfill:
        return trades.agg(F.min(F.col("trade_date").cast("date")).alias("start_date")) \
                     .select("start_date", end_col.alias("end_date"))
    return trades.sparkSession.range(1).select(F.date_sub(end_col, days).alias("start_date"),
                                               end_col.alias("end_date"))


def missing_symbols(requested: DataFrame, fetched: DataFrame) -> DataFrame:
    """Requested symbols that returned no price rows."""
    got = fetched.select("symbol").filter(F.col("symbol").isNotNull())
    return requested.select("symbol").join(got, on="symbol", how="left_anti")


def partition_counts(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows per output partition, the dry-run summary of a partitioned write."""
    cols = list(partition_cols)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


def bronze_partition_counts(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per (dataset, source, year_month) across the bronze datasets."""
    parts = []
    for name, df in bronze.items():
        src = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
        parts.append(df.groupBy(src.alias("source"), "year_month")
                     .agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("dataset"), "source", "year_month", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
