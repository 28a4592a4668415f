"""Bronze layer: lineage-stamped, fingerprinted, month-partitioned raw rows.

``stamp_row_hash`` is the fingerprint step of every ingest.  The occurrence
number (0, 1, 2 ... among identical rows of one export file, in file order)
keeps genuine repeats apart while letting a re-download of the same file hash
to the same values, so silver can drop it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import NULL_MARK, SEP, hash_text, sha256_hex
from ledgerlake.functions.numeric import dbl_to_dec
from ledgerlake.functions.text import account_label, is_ledger_action
from ledgerlake.session import shuffle_partitions
from ledgerlake.sources import driver_tables as dt

# Typed key parts of each fingerprint (money in its silver decimal type, so a
# value hashes the same whether it arrives as 12.5 or 12.50).
BANK_KEY = lambda: [F.col("transaction_date"), F.col("description"),
                    dbl_to_dec("amount", 18, 2)]
TRADE_KEY = lambda: [F.col("trade_date"), F.col("account"), F.col("action"),
                     F.col("symbol"), dbl_to_dec("quantity", 18, 6),
                     dbl_to_dec("price", 18, 4), dbl_to_dec("amount", 18, 2)]
PRICE_KEY = lambda: [F.col("price_date"), F.col("symbol"), dbl_to_dec("close", 18, 4)]


BUCKET = "row_bucket"
OCCURRENCE = "row_occurrence"


def by_text(text: Column) -> Column:
    """What rows are dealt by: the 64-bit hash of their key text."""
    return F.xxhash64(text)


def by_symbol(text: Column) -> Column:
    """The same for price rows, by symbol: a symbol's prices, which the calendar bounds, share a
    task, so their latest one is found there.

    Date and close hold no separator, so a key text has one symbol; a missing symbol is the
    NULL mark in it, and its rows are dealt by the text.
    """
    symbol = F.col("symbol")
    return F.xxhash64(F.when(symbol != NULL_MARK, symbol).otherwise(text))


def deal(raw: DataFrame, parts: Sequence[Column], bucket=by_text,
         tasks: int | None = None) -> DataFrame:
    """Rows dealt by a 64-bit hash that their key text settles, which is not shipped itself.

    For plans that read the fingerprint: the window of ``stamp_row_hash`` and the dedup per
    (row_bucket, row_hash) then take their rows as they lie, so a row is shuffled once, with
    its parsed columns only; key text and fingerprint are made behind the exchange.  All
    copies of a row share a task, which streams over them sorted, in constant memory.

    ``tasks``: how many tasks sort the rows.  Without it adaptive execution merges partitions
    by their compressed bytes; narrow rows then meet in a task by the million, and its sorts
    spill.  Plans that write files per task leave it out.
    """
    return raw.repartition(*([tasks] if tasks else []), bucket(hash_text(parts)))


def stamp_row_hash(df: DataFrame, parts: Sequence[Column], with_occurrence: bool = True,
                   file_col: str = "source_file", pos_col: str = "pos",
                   out: str = "row_hash", bucket=by_text, keep_occurrence: bool = False
                   ) -> DataFrame:
    """Add ``row_hash`` and ``row_bucket`` (a 64-bit hash that the key text settles).

    Occurrences are numbered per (file, key text); ``row_bucket`` leads the window key, so
    the sort compares a fixed-width prefix first.  Nothing is repartitioned here: a query
    that does not read the hash drops the window and its exchange with the column.
    """
    df = df.withColumn("_base", hash_text(parts)).withColumn(BUCKET, bucket(F.col("_base")))
    text = F.col("_base")
    if with_occurrence:
        w = Window.partitionBy(BUCKET, file_col, "_base").orderBy(F.col(pos_col).asc_nulls_last())
        df = df.withColumn(OCCURRENCE, F.row_number().over(w) - 1)
        text = _numbered(text)
    out_of = df.withColumn(out, sha256_hex(text)).drop("_base")
    return out_of if keep_occurrence else out_of.drop(OCCURRENCE)


def _numbered(text: Column) -> Column:
    return F.concat_ws(SEP, text, F.col(OCCURRENCE).cast("string"))


def year_month(date_col: str) -> Column:
    """Partition key 'YYYY-MM' of a date (K1)."""
    return F.date_format(F.col(date_col), "yyyy-MM")


def bronze_bank(raw: DataFrame) -> DataFrame:
    df = raw.withColumn("source_account_hint", account_label(F.col("source_file")))
    df = stamp_row_hash(df, BANK_KEY())
    return df.withColumn("year_month", year_month("transaction_date"))


def bronze_trades(raw: DataFrame) -> DataFrame:
    df = raw.withColumn("source_account_hint", account_label(F.col("source_file")))
    df = stamp_row_hash(df, TRADE_KEY())
    return df.withColumn("year_month", year_month("trade_date"))


def ledger_rows(raw: DataFrame) -> DataFrame:
    """Raw trades that the ledger can read, for plans that read nothing else of them.

    Copies of a row have its key text, hence its action; only a separator inside a field
    can give other rows the same text, so rows with one all stay.
    """
    odd = F.concat_ws("", "account", "action", "symbol").contains(SEP)
    return raw.filter(is_ledger_action("action") | odd)


def bronze_ledger(raw: DataFrame) -> DataFrame:
    """``bronze_trades`` with the occurrence number, which a later step can make the hash of."""
    df = raw.withColumn("source_account_hint", account_label(F.col("source_file")))
    return stamp_row_hash(df, TRADE_KEY(), keep_occurrence=True)


def trade_hash() -> Column:
    """The fingerprint of a typed trade from its key columns and occurrence number.

    A money column of silver has the value and type of its part of the key (landed as double).
    """
    return sha256_hex(_numbered(hash_text(["trade_date", "account", "action", "symbol",
                                           "quantity", "price", "amount"])))


def price_hash() -> Column:
    """The fingerprint of a typed price row (landed as double)."""
    return sha256_hex(hash_text(["price_date", "symbol", "close"]))


def bronze_prices(raw: DataFrame) -> DataFrame:
    df = stamp_row_hash(raw, PRICE_KEY(), with_occurrence=False, bucket=by_symbol)
    return df.withColumn("year_month", year_month("price_date"))


#: Dataset -> (rows of the parser, bronze step, key of the fingerprint).
DATASETS = {
    "bank_transactions": (dt.raw_bank_rows, bronze_bank, BANK_KEY),
    "trades": (dt.raw_trade_rows, bronze_trades, TRADE_KEY),
    "stock_prices": (dt.raw_price_rows, bronze_prices, PRICE_KEY),
}


def bronze_from_driver(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False
                       ) -> DataFrame:
    """One bronze dataset, derived from the driver tables.

    ``dealt`` is for plans that read the fingerprint (see ``deal``); without it a plan that
    does not read it has no exchange.
    """
    raw, stamp, key = DATASETS[name]
    rows = raw(spark, sf_dir)
    bucket = by_symbol if name == "stock_prices" else by_text
    return stamp(deal(rows, key(), bucket) if dealt else rows)


def price_facts_from_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt bronze prices for readers of facts, over all shuffle partitions of the session."""
    rows = dt.raw_price_rows(spark, sf_dir)
    return bronze_prices(deal(rows, PRICE_KEY(), by_symbol, shuffle_partitions(spark)))


def ledger_from_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt bronze rows of the ledger's trades, with their occurrence numbers, over all shuffle
    partitions of the session."""
    rows = ledger_rows(dt.raw_trade_rows(spark, sf_dir))
    return bronze_ledger(deal(rows, TRADE_KEY(), tasks=shuffle_partitions(spark)))
