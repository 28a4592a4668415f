"""Registry of runnable queries over the driver tables.

``build(spark, sf_dir)`` wires bronze -> silver -> gold lazily from the driver
tables; ``QUERIES`` maps a query name to a function (spark, sf_dir) -> DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.text import is_ledger_action
from ledgerlake.operators import quality
from ledgerlake.operators.ledger_fold import (LEDGER_COLUMNS, ORDER_COLUMNS, _first_of_null_keys,
                                              position_lots_in_place)
from ledgerlake.operators.scan import sequence_number
from ledgerlake.operators.ledger_fold import position_lots as fold_position_lots
from ledgerlake.plans import bronze as bronze_plan
from ledgerlake.plans import (ingest, portfolio, present, replays, roundtrips, silver, spending,
                              wealth)
from ledgerlake.session import materialize, scratch_path, ship_package, shuffle_partitions
from ledgerlake.sinks.writers import export_counts, write_laid_out
from ledgerlake.sources import driver_tables


@dataclass
class Models:
    """Lazily built tables of one run; each property is built once per run.

    Nothing runs while a model is built.  With ``share=True`` a table that several
    downstream models read (silver tables, the ledger, investment_growth) is written as
    Parquet in the shared checkpoint folder when it is first asked for, so it is computed
    once and its lineage is cut; otherwise every consumer derives it in its own plan.
    With ``gold_only=True`` only gold tables are results: of the silver tables, the columns that
    gold reads are written, trades laid out by symbol, and hashes are made again from them.
    """
    spark: SparkSession
    sf_dir: str
    share: bool = False
    gold_only: bool = False
    cache: dict = field(default_factory=dict)

    SHARED = ("stg_transactions", "stg_trades", "stg_stock_prices", "position_lots",
              "investment_growth")

    def _get(self, name: str, fn: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.cache:
            df = fn()
            if self.share and name in self.SHARED:
                df = materialize(df, name)
            self.cache[name] = df
        return self.cache[name]

    def bronze(self, name: str) -> DataFrame:
        return self._get(f"bronze_{name}",
                         lambda: bronze_plan.bronze_from_driver(self.spark, self.sf_dir, name))

    def dealt(self, name: str) -> DataFrame:
        """The bronze rows for plans that read the fingerprint (one exchange up to silver)."""
        return self._get(f"dealt_{name}", lambda: bronze_plan.bronze_from_driver(
            self.spark, self.sf_dir, name, dealt=True))

    def all_bronze(self) -> dict[str, DataFrame]:
        return {name: self.bronze(name) for name in bronze_plan.DATASETS}

    @property
    def stg_transactions(self) -> DataFrame:
        if self.gold_only:
            return self._get("card_facts", lambda: materialize(silver.stg_transactions(
                self.dealt("bank_transactions")).select(*silver.CARD_FACTS), "card_facts"))
        return self._get("stg_transactions",
                         lambda: silver.stg_transactions(self.dealt("bank_transactions")))

    @property
    def stg_trades(self) -> DataFrame:
        if self.gold_only:
            return self._get("laid_out_trades", self._laid_out_trades)
        return self._get("stg_trades", lambda: silver.stg_trades(self.dealt("trades")))

    @property
    def stg_stock_prices(self) -> DataFrame:
        return self._get("stg_stock_prices",
                         lambda: silver.stg_stock_prices(self.dealt("stock_prices")))

    @property
    def price_facts(self) -> DataFrame:
        """Date, symbol and close of the silver prices, from the shared table if there is one."""
        if self.gold_only:
            return self._get("price_facts", lambda: materialize(
                self._facts().drop("row_hash"), "price_facts")
                .withColumn("row_hash", bronze_plan.price_hash()))
        if self.share:
            return self.stg_stock_prices.select(*silver.PRICE_FACTS)
        return self._get("price_facts", self._facts)

    def _facts(self) -> DataFrame:
        return silver.price_facts(bronze_plan.price_facts_from_driver(self.spark, self.sf_dir))

    @property
    def bare_prices(self) -> DataFrame:
        """The price facts for the latest price, which makes their hashes itself."""
        return self.price_facts.drop("row_hash")

    @property
    def ledger_trades(self) -> DataFrame:
        """The silver trades of the ledger, with what their hashes are made of."""
        return self._get("ledger_trades", lambda: silver.ledger_trades(
            bronze_plan.ledger_from_driver(self.spark, self.sf_dir)))

    def _laid_out_trades(self) -> DataFrame:
        """The ledger's trades as a table by symbol: the ledger fold and the holdings of a symbol
        read it as it lies.  Of the rows without a symbol, the ledger reads the first ones only."""
        ship_package(self.spark)
        cols = [*LEDGER_COLUMNS, bronze_plan.OCCURRENCE]
        rows = self.ledger_trades.filter(is_ledger_action("action")).select(*cols, "row_hash")
        rows = rows.mapInArrow(partial(_first_of_null_keys, keys=["symbol"]), rows.schema)
        name = f"ledgerlake_gold_trades_{uuid.uuid4().hex[:12]}"
        write_laid_out(rows.select(*cols), name, ["symbol"], ["source", "trade_date"],
                       int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                       scratch_path(self.spark, "gold-trades"))
        return self.spark.table(name).withColumn("row_hash", bronze_plan.trade_hash())

    @property
    def position_lots(self) -> DataFrame:
        if self.gold_only:
            return self._get("position_lots", lambda: position_lots_in_place(self.stg_trades))
        if self.share:
            return self._get("position_lots", lambda: fold_position_lots(self.stg_trades))
        return self._get("position_lots", lambda: fold_position_lots(
            self.ledger_trades, shuffle_partitions(self.spark),
            made_of=([bronze_plan.OCCURRENCE], bronze_plan.trade_hash())))

    @property
    def realized_gains(self) -> DataFrame:
        return self._get("realized_gains", lambda: portfolio.realized_gains(self.position_lots))

    @property
    def unrealized_gains(self) -> DataFrame:
        return self._get("unrealized_gains",
                         lambda: portfolio.unrealized_gains(self.position_lots,
                                                            self.bare_prices))

    @property
    def investment_growth(self) -> DataFrame:
        return self._get("investment_growth",
                         lambda: portfolio.growth_of_lots(self.position_lots,
                                                          self.bare_prices))

    @property
    def monthly_spending(self) -> DataFrame:
        return self._get("monthly_spending",
                         lambda: spending.monthly_spending(self.stg_transactions))

    @property
    def wealth_summary(self) -> DataFrame:
        return self._get("wealth_summary",
                         lambda: wealth.wealth_summary(self.stg_transactions, self.stg_trades,
                                                       self.price_facts))

    @property
    def portfolio_roe_summary(self) -> DataFrame:
        return self._get("portfolio_roe_summary",
                         lambda: portfolio.portfolio_roe_summary(self.investment_growth))

    GOLD = ("wealth_summary", "monthly_spending", "position_lots", "realized_gains",
            "unrealized_gains", "investment_growth", "portfolio_roe_summary")

    def gold(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.GOLD}

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


def build(spark: SparkSession, sf_dir: str, share: bool = False, gold_only: bool = False
          ) -> Models:
    return Models(spark, sf_dir, share, gold_only)


# Ad-hoc tickers requested on top of traded and watched symbols,
# and the refresh end date used by the registered backfill query.
EXTRA_TICKERS = ("NVDA", "COIN")
BACKFILL_END = "2001-12-31"
#: Fixed value: the start that the registered refresh asks for.
REFRESH_START = "2001-11-05"
#: The days that the registered price request asked for.
BOUNDS = ("1996-01-01", "2000-12-31")


def universe(m: Models) -> DataFrame:
    watch = ingest.watchlist_symbols(driver_tables.watchlist_rows(m.spark, m.sf_dir))
    return ingest.ticker_universe(m.bronze("trades"), watch, EXTRA_TICKERS)


def refresh_windows(m: Models) -> DataFrame:
    """The window of every kind of refresh (G6), with the price rows that it covers."""
    prices = m.bronze("stock_prices")
    out = []
    for kind, given in (("backfill", {"backfill": True}), ("days", {}),
                        ("start", {"start": REFRESH_START, "backfill": True})):
        w = ingest.backfill_window(m.bronze("trades"), BACKFILL_END, **given)
        inside = F.col("price_date").between(F.col("start_date"), F.col("end_date"))
        covered = prices.join(F.broadcast(w), inside).agg(F.count(F.lit(1)).alias("rows"))
        out.append(w.crossJoin(covered).select(  # both have one row
            F.lit(kind).alias("kind"), "start_date", "end_date", "rows"))
    return reduce(DataFrame.unionByName, out)


def quality_report(m: Models) -> DataFrame:
    """Every model test on every silver and gold table, one row per rule."""
    return reduce(DataFrame.unionByName, [
        quality.check(m.table(table), table, quality.model_rules(table))
        for table in quality.MODEL_RULES])


def damaged_report(m: Models) -> DataFrame:
    """The ingest checks over damaged batches, and over a statement without rows."""
    empty = m.bronze("bank_transactions").filter(F.col("year_month") < "1900-01")
    return quality.ingest_report(roundtrips.damaged_bronze(m)).unionByName(quality.check(
        empty, "empty_upload", quality.INGEST_RULES["bank_transactions"]))


def trade_sequence(stg_trades: DataFrame) -> DataFrame:
    """Ledger order number per (symbol, source) (W2), row_hash as final tie-break."""
    rows = (stg_trades.filter(is_ledger_action("action"))
            .select("symbol", "source", "trade_date", "amount", "row_hash"))
    return sequence_number(rows, ["symbol", "source"], ORDER_COLUMNS[0],
                           [F.col(c).asc_nulls_last() for c in ORDER_COLUMNS[1:]], "rn")


BANK_BRONZE_OUT = ["transaction_date", "description", "amount", "category_raw",
                   "source_account_hint", "source", "source_file", "pos", "row_hash", "year_month"]


def _q(fn: Callable[[Models], DataFrame], share: bool = False, gold_only: bool = False
       ) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(build(spark, sf_dir, share, gold_only))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_hash_occurrence": _q(lambda m: m.bronze("bank_transactions").select(*BANK_BRONZE_OUT)),
    "stg_transactions_dedup": _q(lambda m: m.stg_transactions),
    "stg_trades_dedup": _q(lambda m: m.stg_trades),
    "stg_prices_dedup": _q(lambda m: m.stg_stock_prices),
    "monthly_spending": _q(lambda m: spending.monthly_spending(m.stg_transactions)),
    "trade_sequence": _q(lambda m: trade_sequence(m.stg_trades)),
    "position_lots": _q(lambda m: m.position_lots),
    "realized_gains": _q(lambda m: m.realized_gains),
    "latest_position": _q(lambda m: portfolio.latest_position(m.position_lots)),
    "latest_price": _q(lambda m: portfolio.latest_price(m.bare_prices)),
    "unrealized_gains": _q(lambda m: m.unrealized_gains),
    "realized_by_position": _q(lambda m: portfolio.realized_by_position(m.realized_gains)),
    "investment_growth": _q(lambda m: m.investment_growth),
    "portfolio_roe_summary": _q(lambda m: m.portfolio_roe_summary),
    "calendar_spine": _q(lambda m: wealth.calendar_spine(m.stg_transactions, m.price_facts)),
    "cash_running": _q(lambda m: wealth.cash_running(m.stg_transactions)),
    "running_holdings": _q(lambda m: wealth.running_holdings(m.stg_trades)),
    "holdings_asof": _q(lambda m: wealth.holdings_asof(m.price_facts,
                                                      wealth.running_holdings(m.stg_trades))),
    "portfolio_value_by_day": _q(lambda m: wealth.portfolio_value_by_day(
        wealth.holdings_asof(m.price_facts, wealth.running_holdings(m.stg_trades)))),
    "forward_fill": _q(lambda m: wealth.forward_fill(
        wealth.cash_running(m.stg_transactions),
        wealth.portfolio_value_by_day(
            wealth.holdings_asof(m.price_facts, wealth.running_holdings(m.stg_trades))))),
    "wealth_summary": _q(lambda m: m.wealth_summary),
    "year_month_partition_counts": _q(lambda m: ingest.bronze_partition_counts(m.all_bronze())),
    "ticker_universe": _q(universe),
    "missing_symbols_anti": _q(lambda m: ingest.missing_symbols(universe(m),
                                                                m.bronze("stock_prices"))),
    "backfill_bounds": _q(lambda m: ingest.backfill_window(m.bronze("trades"), BACKFILL_END,
                                                           backfill=True)),
    "refresh_windows": _q(refresh_windows),
    "sign_violations": _q(lambda m: quality.sign_violations(m.bronze("trades"))),
    "quality_report": _q(quality_report, share=True),
    "gold_export_counts": _q(lambda m: export_counts(roundtrips.gold_export(m)), gold_only=True),
    "gold_export_contents": _q(lambda m: roundtrips.gold_rows(roundtrips.gold_export(m)),
                               gold_only=True),
    "ingest_report": _q(lambda m: quality.ingest_report(m.all_bronze())),
    "damaged_ingest_report": _q(damaged_report),
    "statement_span": _q(lambda m: quality.statement_span(m.bronze("bank_transactions"),
                                                          "transaction_date")),
    "price_date_bounds": _q(lambda m: quality.date_bounds(
        m.bronze("stock_prices"), "price_date", *BOUNDS).select("price_date", "symbol", "close",
                                                                 "row_hash")),
    "null_price_or_quantity": _q(lambda m: quality.null_price_or_quantity(
        roundtrips.damaged_bronze(m)["trades"]).select("trade_date", "account", "action", "symbol",
                                                       "row_hash")),
    "source_roundtrip": _q(roundtrips.cards),
    "fidelity_roundtrip": _q(roundtrips.fidelity),
    "vanguard_roundtrip": _q(roundtrips.vanguard),
    "price_grid": _q(roundtrips.price_grid),
    "watchlist_file": _q(roundtrips.watchlist_file),
    "materialised_spending": _q(roundtrips.materialised_spending),
    "lake_trades": _q(roundtrips.lake_trades),
    "lake_prices": _q(roundtrips.lake_prices),
    "monthly_spending_ranked": _q(lambda m: present.ranked("monthly_spending", m.monthly_spending,
                                                           ["category"])),
    "roe_summary_ranked": _q(lambda m: present.ranked("portfolio_roe_summary",
                                                      m.portfolio_roe_summary)),
    "position_lots_ranked": _q(lambda m: present.placed(
        "position_lots", m.position_lots, ["symbol", "source"], ["rn"])),
    "realized_gains_ranked": _q(lambda m: present.placed(
        "realized_gains", m.realized_gains, ["trade_date"],
        ["symbol", "source", "account", "shares_sold", "sale_price", "proceeds",
         "realized_gain"])),
    "unrealized_gains_ranked": _q(lambda m: present.ranked(
        "unrealized_gains", m.unrealized_gains, ["symbol", "source"])),
    "wealth_summary_ranked": _q(lambda m: present.ranked("wealth_summary", m.wealth_summary)),
    "growth_preview": _q(lambda m: present.preview(present.present(
        "investment_growth", m.investment_growth, ["symbol", "source"]))),
    "two_generations": _q(roundtrips.two_generations),
    "catalog_lots": _q(roundtrips.catalog_lots),
    "header_audit": _q(roundtrips.chase_audit),
    "uneven_roundtrip": _q(roundtrips.uneven_roundtrip),
    "publish_report": _q(roundtrips.publish_report),
    "running_cost_stream": _q(replays.running_cost),
    "incremental_silver": _q(replays.silver_trades),
    "incremental_spending": _q(replays.monthly_spending),
    "incremental_wealth": _q(replays.wealth_summary),
}
