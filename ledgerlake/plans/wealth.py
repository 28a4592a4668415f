"""wealth_summary (G16): daily net worth, forward filled, with day-over-day ROI.

Sub-steps, each usable on its own:
  calendar_spine        distinct transaction days U distinct price days (U1)
  cash_running          running sum of per-day card amounts (A3, W6)
  running_holdings      end-of-day shares per symbol: per-day net, then running sum (W7)
  holdings_asof         each price row with the shares held at that day (J6)
  portfolio_value_by_day  sum(shares * close) per price day (A4)
  forward_fill          calendar with last known cash and portfolio value (W8)
  wealth_summary        + net worth, prior day, ROI (W9)

Every window without a partition runs over one row per calendar day, whose
count is bounded by the date range (about 365 rows a year) and not by the data
volume; all per-row work before it is a partial aggregation.  Several trades
of one symbol on one day are netted first, so the end-of-day position is
well defined (the row-by-row running total would depend on tie order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numeric import pct
from ledgerlake.functions.text import is_ledger_action, signed_quantity
from ledgerlake.operators.asof import asof_join

SUMMARY_COLUMNS = ["as_of_date", "cash_balance", "portfolio_value", "net_worth",
                   "prior_net_worth", "day_over_day_roi_pct"]


def calendar_spine(stg_transactions: DataFrame, stg_prices: DataFrame) -> DataFrame:
    days = stg_transactions.select(F.col("transaction_date").alias("d"))
    return days.union(stg_prices.select(F.col("price_date").alias("d"))).distinct()


def daily_cash_flow(stg_transactions: DataFrame) -> DataFrame:
    return stg_transactions.groupBy("transaction_date").agg(
        F.sum("amount").cast("decimal(38,2)").alias("day_amount"))


def cash_running(stg_transactions: DataFrame, spend_sign: int = 1,
                 opening: DataFrame | None = None) -> DataFrame:
    """Running card balance by day.  ``spend_sign=-1`` makes spending lower it.

    ``opening`` (transaction_date, cash_balance): the balance at the end of an earlier day.
    """
    daily = daily_cash_flow(stg_transactions)
    amt = F.col("day_amount") if spend_sign == 1 else -F.col("day_amount")
    flow = daily.select("transaction_date", amt.cast("decimal(38,2)").alias("flow"))
    if opening is not None:
        flow = flow.unionByName(opening.select("transaction_date", F.col("cash_balance").alias("flow")))
    w = Window.orderBy(F.col("transaction_date").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return flow.select("transaction_date",
                       F.sum("flow").over(w).cast("decimal(38,2)").alias("cash_balance"))


def net_by_day(stg_trades: DataFrame) -> DataFrame:
    """Shares bought less shares sold per symbol and day (NULL symbols dropped)."""
    return (stg_trades.filter(is_ledger_action("action") & F.col("symbol").isNotNull())
            .groupBy("symbol", "trade_date")
            .agg(F.sum(signed_quantity("action", "quantity")).cast("decimal(38,6)").alias("day_qty")))


def running_holdings(stg_trades: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """End-of-day shares held per symbol, across sources.

    ``opening`` (symbol, trade_date, day_qty): what was held at the end of an earlier day.
    """
    net = net_by_day(stg_trades)
    if opening is not None:
        net = net.unionByName(opening.select("symbol", "trade_date", "day_qty"))
    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0)
    return net.select("trade_date", "symbol",
                      F.sum("day_qty").over(w).cast("decimal(38,6)").alias("shares_held"))


def holdings_asof(stg_prices: DataFrame, holdings: DataFrame) -> DataFrame:
    """Every price row with the shares held at the end of the latest trade day <= price day.

    A symbol has one holdings row a day and few prices, so its time is not cut.
    """
    px = stg_prices.select("price_date", "symbol", "close")
    return asof_join(px, holdings, by=["symbol"], left_time="price_date",
                     right_time="trade_date", value_cols=["shares_held"], bucket=None)


def portfolio_value_by_day(asof_rows: DataFrame) -> DataFrame:
    shares = F.coalesce(F.col("shares_held"), F.lit(0)).cast("decimal(19,6)")
    return asof_rows.groupBy(F.col("price_date").alias("as_of_date")).agg(
        F.sum(shares * F.col("close")).cast("decimal(38,10)").alias("portfolio_value"))


def with_roi(filled: DataFrame) -> DataFrame:
    cash = F.coalesce("cash_balance", F.lit(0)).cast("decimal(38,2)")
    value = F.coalesce("portfolio_value", F.lit(0)).cast("decimal(38,10)")
    net = (cash.cast("decimal(27,2)") + value.cast("decimal(37,10)")).cast("decimal(38,10)")
    base = filled.select("as_of_date", cash.alias("cash_balance"),
                         value.alias("portfolio_value"), net.alias("net_worth"))
    prior = F.lag("net_worth").over(Window.orderBy(F.col("as_of_date").asc_nulls_last()))
    step = base.withColumn("prior_net_worth", prior.cast("decimal(38,10)"))
    change = (F.col("net_worth").cast("decimal(37,10)")
              - F.col("prior_net_worth").cast("decimal(37,10)"))
    return step.withColumn("day_over_day_roi_pct", pct(change, "prior_net_worth", 2)) \
               .select(*SUMMARY_COLUMNS)


def forward_fill(cash: DataFrame, value: DataFrame) -> DataFrame:
    """The calendar with the last known cash and portfolio value of every day.

    The calendar is exactly the union of the days with card activity and the days with
    prices, i.e. the days of a full outer join of the two per-day tables.  A NULL day is
    in the calendar once, comes last and matches neither table (an equality join).
    """
    days = (cash.select(F.col("transaction_date").alias("d"), "cash_balance",
                        F.lit(None).cast("decimal(38,10)").alias("portfolio_value"))
            .unionByName(value.select(F.col("as_of_date").alias("d"),
                                      F.lit(None).cast("decimal(38,2)").alias("cash_balance"),
                                      "portfolio_value"))
            .groupBy("d").agg(*[F.max(F.when(F.col("d").isNotNull(), F.col(c))).alias(c)
                                for c in ("cash_balance", "portfolio_value")]))
    w = Window.orderBy(F.col("d").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return days.select(
        F.col("d").alias("as_of_date"),
        F.last("cash_balance", ignorenulls=True).over(w).alias("cash_balance"),
        F.last("portfolio_value", ignorenulls=True).over(w).alias("portfolio_value"))


def wealth_summary(stg_transactions: DataFrame, stg_trades: DataFrame, stg_prices: DataFrame,
                   spend_sign: int = 1) -> DataFrame:
    """Each silver table is read once: card days come from the daily cash flow,
    price days from the per-day portfolio value."""
    cash = cash_running(stg_transactions, spend_sign)
    value = portfolio_value_by_day(holdings_asof(stg_prices, running_holdings(stg_trades)))
    return with_roi(forward_fill(cash, value))
