"""Investment marts built on the running ledger.

Latest-row-per-key steps are aggregations (max of an ordered struct), so a hot
key is reduced map-side before any shuffle.  Joins are between per-key
aggregates; AQE turns them into broadcast joins when the measured size of a
side is under the broadcast threshold, and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numeric import pct, round_dbl, safe_div
from ledgerlake.functions.text import is_sell
from ledgerlake.operators.dedup import latest_by
from ledgerlake.plans.bronze import price_hash

REALIZED_COLUMNS = ["trade_date", "symbol", "source", "account", "shares_sold", "sale_price",
                    "proceeds", "realized_gain"]
UNREALIZED_COLUMNS = ["symbol", "source", "account", "shares_held", "cost_basis",
                      "avg_cost_per_share", "current_price", "priced_as_of", "market_value",
                      "unrealized_gain"]
GROWTH_COLUMNS = ["symbol", "source", "total_realized_gain", "current_cost_basis",
                  "current_market_value", "unrealized_gain", "total_gain", "roe_pct"]
SUMMARY_MEASURES = ["total_realized_gain", "current_cost_basis", "current_market_value",
                    "unrealized_gain", "total_gain"]
SUMMARY_COLUMNS = ["source"] + SUMMARY_MEASURES + ["roe_pct"]

# Fixed value: the label of the portfolio-wide summary row.
ALL_SOURCES = "ALL"


def realized_gains(lots: DataFrame) -> DataFrame:
    """One row per sell of the ledger."""
    return lots.filter(is_sell("action")).select(
        "trade_date", "symbol", "source", "account",
        F.col("quantity").alias("shares_sold"), F.col("price").alias("sale_price"),
        F.col("amount").alias("proceeds"), "realized_gain")


def latest_position(lots: DataFrame) -> DataFrame:
    """Last ledger row per (symbol, source), by (trade_date, rn)."""
    return latest_by(lots, ["symbol", "source"], ["trade_date", "rn"],
                     keep=["account", "shares_held", "cost_basis"])


def latest_price(stg_prices: DataFrame) -> DataFrame:
    """Most recent close per symbol (W4); row_hash breaks same-day ties.

    Prices without their hash have it made of date, symbol and close when they are compared.
    """
    made = {} if "row_hash" in stg_prices.columns else {"row_hash": price_hash()}
    return (latest_by(stg_prices, ["symbol"], ["price_date", "row_hash"], keep=["close"],
                      made_of=made)
            .select("symbol", F.col("close").alias("current_price"), "price_date"))


def unrealized_gains(lots: DataFrame, stg_prices: DataFrame) -> DataFrame:
    """Open positions valued at the latest close."""
    held = latest_position(lots).filter(F.col("shares_held") > 0)
    px = latest_price(stg_prices)
    j = held.join(px, on="symbol", how="left")
    mv = F.col("shares_held") * F.col("current_price")
    return j.select(
        "symbol", "source", "account", "shares_held",
        F.round("cost_basis", 2).cast("decimal(18,2)").alias("cost_basis"),
        round_dbl(safe_div("cost_basis", "shares_held"), 4).alias("avg_cost_per_share"),
        "current_price",
        F.col("price_date").alias("priced_as_of"),
        F.round(mv, 2).cast("decimal(18,2)").alias("market_value"),
        F.round(mv - F.col("cost_basis"), 2).cast("decimal(27,2)").alias("unrealized_gain"))


def realized_by_position(realized: DataFrame) -> DataFrame:
    """Realized gain to date per (symbol, source) (A5)."""
    return realized.groupBy("symbol", "source").agg(
        F.sum("realized_gain").cast("decimal(38,2)").alias("total_realized_gain"))


def investment_growth(realized: DataFrame, unrealized: DataFrame) -> DataFrame:
    """Realized + unrealized gain and return on current cost per position."""
    r = realized_by_position(realized)
    u = unrealized.select("symbol", "source", F.col("cost_basis").alias("current_cost_basis"),
                          "market_value", "unrealized_gain")
    j = r.join(u, on=["symbol", "source"], how="full_outer")
    return _growth_columns(j)


def _growth_columns(j: DataFrame) -> DataFrame:
    zero = F.lit(0)
    tr = F.coalesce("total_realized_gain", zero).cast("decimal(38,2)")
    ug = F.coalesce("unrealized_gain", zero).cast("decimal(27,2)")
    cost = F.coalesce("current_cost_basis", zero).cast("decimal(18,2)")
    total = (tr.cast("decimal(37,2)") + ug).cast("decimal(38,2)")
    return j.select(
        "symbol", "source",
        tr.alias("total_realized_gain"),
        cost.alias("current_cost_basis"),
        F.coalesce("market_value", zero).cast("decimal(18,2)").alias("current_market_value"),
        ug.alias("unrealized_gain"),
        total.alias("total_gain"),
        pct(total, cost, 2).alias("roe_pct"))


def growth_of_lots(lots: DataFrame, stg_prices: DataFrame) -> DataFrame:
    """``investment_growth`` straight from the ledger, which is read once.

    Realized gain and latest row of a position come from one aggregation; joining the two
    marts instead would fold the ledger twice.  Rows are those of the full outer join:
    positions with a sell, or still open.  A key with a NULL matches nothing there, so its
    realized and its open part stay separate rows.
    """
    order = F.struct(F.col("trade_date").alias("d"), F.col("rn").alias("n"),
                     F.col("shares_held").alias("shares_held"),
                     F.col("cost_basis").alias("cost_basis"))
    sold = is_sell("action")
    pos = (lots.groupBy("symbol", "source")
           .agg(F.sum(F.when(sold, F.col("realized_gain"))).cast("decimal(38,2)").alias("gain"),
                F.count_if(sold).alias("sells"), F.max(order).alias("p"))
           .select("symbol", "source", "gain", (F.col("sells") > 0).alias("has_sell"),
                   F.col("p.shares_held").alias("shares"), F.col("p.cost_basis").alias("cost"),
                   F.coalesce(F.col("p.shares_held") > 0, F.lit(False)).alias("open"))
           .filter("has_sell OR open"))
    px = latest_price(stg_prices).select(F.col("symbol").alias("px"), "current_price")
    j = pos.join(px, (F.col("symbol") == F.col("px")) & F.col("open"), "left")
    market = F.col("shares") * F.col("current_price")
    no_gain = F.lit(None).cast("decimal(38,2)")
    no_money, no_diff = F.lit(None).cast("decimal(18,2)"), F.lit(None).cast("decimal(27,2)")

    def row(gain, cost, value, diff):
        return F.struct(gain.alias("gain"), cost.alias("cost"), value.alias("value"),
                        diff.alias("diff"))

    cost = F.when(F.col("open"), F.round("cost", 2).cast("decimal(18,2)"))
    value = F.when(F.col("open"), F.round(market, 2).cast("decimal(18,2)"))
    diff = F.when(F.col("open"), F.round(market - F.col("cost"), 2).cast("decimal(27,2)"))
    apart = ((F.col("symbol").isNull() | F.col("source").isNull())
             & F.col("has_sell") & F.col("open"))
    rows = F.when(apart, F.array(row(F.col("gain"), no_money, no_money, no_diff),
                                 row(no_gain, cost, value, diff))).otherwise(
        F.array(row(F.col("gain"), cost, value, diff)))
    return _growth_columns(j.select("symbol", "source", F.explode(rows).alias("r")).select(
        "symbol", "source", F.col("r.gain").alias("total_realized_gain"),
        F.col("r.cost").alias("current_cost_basis"), F.col("r.value").alias("market_value"),
        F.col("r.diff").alias("unrealized_gain")))


def portfolio_roe_summary(growth: DataFrame) -> DataFrame:
    """'ALL' row plus one row per source (G15), from one pass over ``growth``.

    The sums per source (a handful of rows) are gathered and summed once more; the overall
    row is a global aggregate, so it exists (with NULL measures) for empty input, too.
    """
    by_source = growth.groupBy("source").agg(
        *[F.sum(m).cast("decimal(38,2)").alias(m) for m in SUMMARY_MEASURES])
    whole = by_source.agg(
        *[F.sum(m).cast("decimal(38,2)").alias(m) for m in SUMMARY_MEASURES],
        F.collect_list(F.struct("source", *SUMMARY_MEASURES)).alias("parts"))
    both = whole.select(F.inline(F.concat(
        F.array(F.struct(F.lit(ALL_SOURCES).alias("source"), *SUMMARY_MEASURES)), "parts")))
    return both.select(
        "source",
        *[F.round(m, 2).cast("decimal(38,2)").alias(m) for m in SUMMARY_MEASURES],
        pct("total_gain", "current_cost_basis", 2).alias("roe_pct"))
