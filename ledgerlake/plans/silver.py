"""Silver layer: typed, deduplicated tables.

Each model casts the bronze landing types to the silver types, then keeps the
first-ingested row per row_hash.  Casting happens before the dedup so the
aggregation buffer carries the narrow typed payload.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import canonical_text
from ledgerlake.functions.numeric import dbl_to_dec
from ledgerlake.operators.dedup import dedup_first
from ledgerlake.plans.bronze import BUCKET, OCCURRENCE, price_hash

# The columns of the silver tables.
STG_TRANSACTIONS_COLS = ["transaction_date", "description", "amount", "category_raw",
                         "source_account_hint", "source", "row_hash"]
STG_TRADES_COLS = ["trade_date", "account", "action", "symbol", "currency", "price", "quantity",
                   "amount", "source_account_hint", "source", "row_hash"]
STG_PRICES_COLS = ["price_date", "symbol", "open", "high", "low", "close", "adj_close", "volume",
                   "currency", "row_hash"]


def _bucket(bronze: DataFrame):
    return [F.col("row_bucket")] if "row_bucket" in bronze.columns else []


def _dedup(typed: DataFrame) -> DataFrame:
    """Keep-first per row_hash; grouped with row_bucket when bronze carries it, so the
    grouping compares a fixed-width prefix first, and rows that are dealt by row_bucket
    (``bronze.deal``) are grouped as they lie, without an exchange."""
    keys = ["row_bucket", "row_hash"] if "row_bucket" in typed.columns else ["row_hash"]
    return dedup_first(typed, key=keys)


def _money(col: str, precision: int, scale: int, df: DataFrame):
    """Typed cast of a landed number: doubles scale in binary, others cast directly."""
    dtype = dict(df.dtypes).get(col)
    if dtype in ("double", "float"):
        return dbl_to_dec(col, precision, scale).alias(col)
    return F.col(col).cast(f"decimal({precision},{scale})").alias(col)


def typed_transactions(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("description"),
        _money("amount", 18, 2, bronze),
        F.col("category_raw"), F.col("source_account_hint"), F.col("source"),
        F.col("row_hash"), F.col("ingested_at"), *_bucket(bronze))


def stg_transactions(bronze: DataFrame) -> DataFrame:
    return _dedup(typed_transactions(bronze)).select(*STG_TRANSACTIONS_COLS)


def typed_trades(bronze: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    return bronze.select(
        F.col("trade_date").cast("date").alias("trade_date"),
        F.col("account"), F.col("action"), F.col("symbol"), F.col("currency"),
        _money("price", 18, 4, bronze), _money("quantity", 18, 6, bronze),
        _money("amount", 18, 2, bronze),
        F.col("source_account_hint"), F.col("source"), F.col("row_hash"), F.col("ingested_at"),
        *more, *_bucket(bronze))


def stg_trades(bronze: DataFrame) -> DataFrame:
    return _dedup(typed_trades(bronze)).select(*STG_TRADES_COLS)


def ledger_trades(bronze: DataFrame) -> DataFrame:
    """``stg_trades`` for the ledger, with the occurrence number of each row (the same for all
    rows of a hash) beside the hash."""
    number = [F.col(OCCURRENCE)]
    return _dedup(typed_trades(bronze, number)).select(*STG_TRADES_COLS, OCCURRENCE)


def typed_prices(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        F.col("price_date").cast("date").alias("price_date"), F.col("symbol"),
        *[_money(c, 18, 4, bronze) for c in ("open", "high", "low", "close", "adj_close")],
        F.col("volume").cast("bigint").alias("volume"), F.col("currency"),
        F.col("row_hash"), F.col("ingested_at"), *_bucket(bronze))


def stg_stock_prices(bronze: DataFrame) -> DataFrame:
    return _dedup(typed_prices(bronze)).select(*STG_PRICES_COLS)


# What gold reads of a card row.
CARD_FACTS = ["transaction_date", "amount", "category_raw"]
# What the fingerprint tells about a price row, so that it does not depend on
# which of its copies is kept.
PRICE_FACTS = ["price_date", "symbol", "close", "row_hash"]


def price_facts(bronze: DataFrame) -> DataFrame:
    """``stg_stock_prices`` for readers of date, symbol and close: the same rows, and no other
    column is shipped.

    Rows are grouped by the parts of the key text instead of its hash, which is made of them
    again behind the dedup (landed as double), so no sort carries it.  A missing symbol and a
    symbol that is the NULL mark have one text; of their rows the missing one leads, as NULLs do.
    """
    typed = typed_prices(bronze).select(
        "price_date", canonical_text("symbol").alias("_text"), "close",
        F.col("symbol").isNotNull().alias("_named"), "ingested_at", *_bucket(bronze))
    kept = dedup_first(typed, key=[*[c for c in typed.columns if c == BUCKET],
                                   "_text", "price_date", "close"])
    return (kept.withColumn("symbol", F.when(F.col("_named"), F.col("_text")))
            .withColumn("row_hash", price_hash()).select(*PRICE_FACTS))


TYPED = {"stg_transactions": (typed_transactions, STG_TRANSACTIONS_COLS),
         "stg_trades": (typed_trades, STG_TRADES_COLS),
         "stg_stock_prices": (typed_prices, STG_PRICES_COLS)}
