"""Jobs that write files in an outside layout and read them back (documented writes).

Each function takes the run's models and returns the rows read back, so a query over it
exercises writer, layout and reader on whole driver tables.  Files go to the shared
scratch folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ledger_fold import ORDER_COLUMNS, position_lots_in_place
from ledgerlake.plans import silver
from ledgerlake.plans.gate import write_audit_publish
from ledgerlake.session import scratch_path
from ledgerlake.sinks.writers import (PRICE_PARTITIONS, TRADE_PARTITIONS, Exported,
                                      export_gold, tables_from_catalog, write_bronze,
                                      write_export_files, write_laid_out, write_table)
from ledgerlake.sources import driver_tables
from ledgerlake.sources.exports import (CHASE_COLUMNS, header_audit, normalize_prices, parse_chase,
                                        read_export_csv, read_parquet_or_empty, read_source,
                                        read_watchlist)
from ledgerlake.sources.lake import read_bronze, read_generations

# Header lines, preambles and footers of the written layouts.
CHASE_HEADER = "Transaction Date,Post Date,Description,Category,Type,Amount"
AMEX_HEADER = "Date,Description,Card Member,Account #,Amount,Category"
AMEX_PREAMBLE = ["Card activity", "Prepared for", "Account ending", "", "Period", "Currency"]
FIDELITY_HEADER = "Run Date,Account,Action,Symbol,Type,Currency,Price,Quantity,Fees,Amount"
FIDELITY_PREAMBLE = ["", "Brokerage"]
FIDELITY_FOOTER = ["", "The data is provided", "", "for information,", "only", "", "a", "b", "c",
                   "d", "Date downloaded"]
VANGUARD_HEADER = ("Account Number,Trade Date,Settlement Date,Transaction Description,Symbol,"
                   "Shares,Share Price,Net Amount")
VANGUARD_PREAMBLE = [f"Fund line {i}" if i % 3 else "" for i in range(21)]


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(*fields: Column) -> Column:
    return F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def with_frame(body: DataFrame, head: Sequence[str], foot: Sequence[str] = ()) -> DataFrame:
    """(file, line_no, text) plus the given first and last lines of every file."""
    frame = [(i - len(head), t) for i, t in enumerate(head)]
    frame += [((1 << 62) + i, t) for i, t in enumerate(foot)]
    lines = F.array(*[F.struct(F.lit(n).cast("long").alias("line_no"), F.lit(t).alias("text"))
                      for n, t in frame])
    return body.unionByName(body.select("file").distinct()
                            .select("file", F.explode(lines).alias("x"))
                            .select("file", "x.line_no", "x.text"))


def cards(m) -> DataFrame:
    """The card rows as Chase and Amex exports, parsed back."""
    raw = driver_tables.raw_bank_rows(m.spark, m.sf_dir)
    day = F.date_format("transaction_date", "MM/dd/yyyy")
    member = F.concat(F.lit("HOLDER "), (F.col("pos") % 7).cast("string"))
    kind = F.when(F.col("amount") < 0, "Payment").otherwise("Sale")

    def lines(source: str, text: Column) -> DataFrame:
        return raw.filter(F.col("source") == source).select(
            F.col("source_file").alias("file"), F.col("pos").alias("line_no"), text.alias("text"))

    chase = lines("chase", csv_line(day, day, quoted(F.col("description")), F.col("category_raw"),
                                    kind, -F.col("amount")))
    amex = lines("amex", csv_line(day, quoted(F.col("description")), member, -F.col("pos"),
                                  F.col("amount"), F.col("category_raw")))
    base = scratch_path(m.spark, "export-roundtrip")
    write_export_files(with_frame(chase, [CHASE_HEADER]), f"{base}/chase")
    write_export_files(with_frame(amex, [*AMEX_PREAMBLE, AMEX_HEADER]), f"{base}/amex")
    cols = ["source", "transaction_date", "description", "amount", "category_raw",
            "source_account_hint"]
    extra = {"card_member": "Card Member", "account_number": "Account #"}
    none = [F.lit(None).cast("string").alias(c) for c in extra]
    return (read_source(m.spark, "chase", f"{base}/chase", name_from_folder="file")
            .select(*cols, *none)
            .unionByName(read_source(m.spark, "amex", f"{base}/amex", name_from_folder="file")
                         .select(*cols, *[F.col(f"`{old}`").alias(c)
                                          for c, old in extra.items()])))


def uneven_cards(m) -> str:
    """The Chase rows as exports that are not alike; the folder they are in.

    By the file's year: as they should be, with days first and no category, or with one
    column more and days before months.
    """
    raw = driver_tables.raw_bank_rows(m.spark, m.sf_dir).filter("source = 'chase'")
    kind = F.regexp_extract("source_file", "_([0-9]{4})", 1).cast("int") % 3
    day, name = (lambda f: F.date_format("transaction_date", f)), quoted(F.col("description"))
    amount = -F.col("amount")
    base = scratch_path(m.spark, "uneven-exports")
    for n, text, header in (
            (0, csv_line(day("MM/dd/yyyy"), day("MM/dd/yyyy"), name, F.col("category_raw"),
                         F.lit("Sale"), amount), CHASE_HEADER),
            (1, csv_line(day("d/M/yyyy"), name, amount), "Transaction Date,Description,Amount"),
            (2, csv_line(day("dd/MM/yy"), name, F.col("category_raw"), amount, F.col("pos")),
             "Transaction Date,Description,Category,Amount,Memo")):
        body = raw.filter(kind == n).select(F.col("source_file").alias("file"),
                                            F.col("pos").alias("line_no"), text.alias("text"))
        write_export_files(with_frame(body, [header]), f"{base}/{n}")
    return base


def chase_audit(m) -> DataFrame:
    """What the uneven exports have, by file."""
    rows = header_audit(m.spark, uneven_cards(m), required=CHASE_COLUMNS, name_from_folder="file")
    return rows.select("source_file", F.array_join("found", "|").alias("found"),
                       F.array_join("missing", "|").alias("missing"),
                       F.array_join("extra", "|").alias("extra"), "records",
                       F.try_element_at("date_order", F.lit("Transaction Date")).alias("date_order"))


def uneven_roundtrip(m) -> DataFrame:
    """The uneven exports read together, each date in its file's order."""
    grid = read_export_csv(m.spark, uneven_cards(m), name_from_folder="file")
    return parse_chase(grid).select("source_file", "transaction_date", "description", "amount",
                                    "category_raw")


TRADES_OUT = ["trade_date", "account", "action", "symbol", "currency", "price", "quantity",
              "amount", "source_account_hint", "source"]


def _broker(m, source: str, text: Column, head: Sequence[str], foot: Sequence[str]) -> DataFrame:
    raw = driver_tables.raw_trade_rows(m.spark, m.sf_dir).filter(F.col("source") == source)
    body = raw.select(F.col("source_file").alias("file"), F.col("pos").alias("line_no"),
                      text.alias("text"))
    base = scratch_path(m.spark, f"{source}-roundtrip")
    write_export_files(with_frame(body, head, foot), base)
    return read_source(m.spark, source, base, name_from_folder="file").select(*TRADES_OUT)


def fidelity(m) -> DataFrame:
    """Trade rows as Fidelity ledgers (2 preamble, 11 footer lines), parsed back."""
    line = csv_line(F.date_format("trade_date", "MM/dd/yyyy"), quoted(F.col("account")),
                    quoted(F.concat(F.lit(" "), F.col("action"))), F.col("symbol"), F.lit("Cash"),
                    F.col("currency"), F.col("price"), F.col("quantity"), F.lit("0"),
                    F.col("amount"))
    return _broker(m, "fidelity", line, [*FIDELITY_PREAMBLE, FIDELITY_HEADER], FIDELITY_FOOTER)


def vanguard(m) -> DataFrame:
    """Trade rows as Vanguard ledgers (21 preamble lines), parsed back."""
    line = csv_line(F.col("account"), F.date_format("trade_date", "yyyy-MM-dd"),
                    F.date_format("trade_date", "yyyy-MM-dd"), quoted(F.col("action")),
                    F.col("symbol"), F.col("quantity"), F.col("price"), F.col("amount"))
    return _broker(m, "vanguard", line, [*VANGUARD_PREAMBLE, VANGUARD_HEADER], [])


#: Tickers of the wide grid, one per line number of an order.
GRID = ["AAA", "BBB", "CCC", "DDD", "EEE", "FFF", "GGG"]


def price_grid(m) -> DataFrame:
    """lineitem as a wide grid (one row a day, a ticker per line number) made long.

    Tickers without a row on a day have no close there and are dropped (P8).
    """
    li = driver_tables.table(m.spark, m.sf_dir, "lineitem")
    unit = F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double")
    cells = []
    for i, t in enumerate(GRID, 1):
        here = F.col("l_linenumber") == i
        low, high = F.min(F.when(here, F.col("unit"))), F.max(F.when(here, F.col("unit")))
        cells += [(low + 1).alias(f"{t} Open"), (high + 2).alias(f"{t} High"),
                  low.alias(f"{t} Low"), high.alias(f"{t} Close"),
                  (high - 1).alias(f"{t} Adj Close"),
                  F.sum(F.when(here, F.col("l_quantity"))).alias(f"{t} Volume")]
    wide = (li.select(F.to_date("l_shipdate").alias("Date"), unit.alias("unit"), "l_linenumber",
                      "l_quantity").groupBy("Date").agg(*cells))
    return normalize_prices(wide).drop("ingested_at", "source_file")


def lake_trades(m) -> DataFrame:
    """Bronze trades written by source and month, read back, made silver.

    A dataset that does not exist adds no rows (S8).
    """
    base = scratch_path(m.spark, "lake-trades")
    batch = m.dealt("trades").drop("row_bucket")
    write_bronze(batch, base, TRADE_PARTITIONS)
    none = read_parquet_or_empty(m.spark, f"{base}-absent", batch.schema)
    return silver.stg_trades(read_bronze(m.spark, base, batch.schema).unionByName(none))


def lake_prices(m) -> DataFrame:
    """Bronze prices written by month, one month uploaded again, read by glob.

    The second upload of the month replaces the first one; all other months stay.
    """
    base = scratch_path(m.spark, "lake-prices")
    batch = m.bronze("stock_prices").drop("row_bucket")
    write_bronze(batch.withColumn("close", F.when(F.col("year_month") == "1997-03", -1.0)
                                  .otherwise(F.col("close"))), base, PRICE_PARTITIONS)
    write_bronze(batch.filter("year_month = '1997-03'"), base, PRICE_PARTITIONS)
    return silver.stg_stock_prices(read_bronze(m.spark, base, batch.schema, recursive=True))


#: Fixed value: the first month that the newer writers of two_generations wrote.
NEWER_FROM = "1998-01"


def two_generations(m) -> DataFrame:
    """Bronze prices of two writers, the older one with fewer and narrower columns."""
    base = scratch_path(m.spark, "generations")
    batch = m.bronze("stock_prices").drop("row_bucket")
    newer = F.col("year_month") >= NEWER_FROM
    old = batch.filter(~newer).drop("adj_close").withColumns(
        {"volume": F.col("volume").cast("int"), "high": F.col("high").cast("float")})
    write_bronze(old, f"{base}/batch=1", PRICE_PARTITIONS)
    write_bronze(batch.filter(newer).drop("open"), f"{base}/batch=2", PRICE_PARTITIONS)
    return read_generations(m.spark, base).select(
        "price_date", "symbol", "open", "high", "close", "adj_close", "volume", "row_hash",
        "year_month")


def catalog_lots(m) -> DataFrame:
    """The ledger fold over a catalog table laid out by (symbol, source)."""
    name = f"ledgerlake_trades_{uuid.uuid4().hex[:12]}"
    write_laid_out(m.stg_trades, name, ["symbol", "source"], ORDER_COLUMNS,
                   int(m.spark.conf.get("spark.sql.shuffle.partitions")),
                   scratch_path(m.spark, "catalog-trades"))
    found = tables_from_catalog(m.spark, [name, "ledgerlake_absent"])
    assert found["ledgerlake_absent"] is None
    return position_lots_in_place(found[name])


def watchlist_file(m) -> DataFrame:
    """The watchlist written as a text file and read by the file reader."""
    path = scratch_path(m.spark, "watchlist")
    driver_tables.watchlist_rows(m.spark, m.sf_dir).write.text(path)
    return read_watchlist(m.spark, path)


def materialised_spending(m) -> DataFrame:
    """monthly_spending as a full-refresh table, written twice and read back (K4)."""
    path = scratch_path(m.spark, "monthly-spending")
    for _ in range(2):
        write_table(m.monthly_spending, "monthly_spending", path)
    return m.spark.read.parquet(path)


def _audited(m, name: str) -> DataFrame:
    """A bronze batch to check: dealt, if repeats are numbered (price rows have no exchange)."""
    return m.bronze(name) if name == "stock_prices" else m.dealt(name)


def damaged_bronze(m, sound: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The bronze batches (``sound``, if they are at hand) with damaged rows: every ingest rule
    has something to find."""
    sound = sound or {}
    bank, trades, prices = (sound[n] if n in sound else _audited(m, n)
                            for n in ("bank_transactions", "trades", "stock_prices"))
    n = F.col("pos")
    return {
        "bank_transactions": bank.withColumns({
            "amount": F.when(n % 11 == 0, F.concat(F.lit("$"), F.col("amount").cast("string")))
            .when(n % 13 == 0, None).otherwise(F.col("amount").cast("string")),
            "transaction_date": F.when(n % 7 != 0, F.col("transaction_date")),
            "row_hash": F.when(n % 5 == 0, F.lit("same")).otherwise(F.col("row_hash"))}),
        "trades": trades.withColumns({
            "amount": F.when(n % 17 == 0, None).when(n % 3 == 0, -F.col("amount"))
            .otherwise(F.col("amount")),
            "trade_date": F.when(n % 7 != 0, F.col("trade_date")),
            "price": F.when(n % 19 != 0, F.col("price")),
            "quantity": F.when(n % 23 != 0, F.col("quantity"))}),
        "stock_prices": prices.withColumns({
            "close": F.when(F.day("price_date") != 13, F.col("close")),
            "price_date": F.when(F.day("price_date") == 14, F.lit("1980-01-01").cast("date"))
            .otherwise(F.col("price_date"))}),
    }


def publish_report(m) -> DataFrame:
    """A sound and a damaged batch of every dataset through the gate (V1-V6 with K2, K3).

    One row per batch and rule, with the rows that are in the lake afterwards.
    """
    base = scratch_path(m.spark, "publish")
    sound, lake, rows = {n: _audited(m, n) for n in m.all_bronze()}, {}, []
    for kind in ("sound", "damaged"):
        # The damaged batches are made of the published ones, which are not derived again.
        for name, batch in (sound if kind == "sound" else damaged_bronze(m, lake)).items():
            target = f"{base}/{kind}-{name}"
            audit = write_audit_publish(
                batch, name, target, PRICE_PARTITIONS if name == "stock_prices" else TRADE_PARTITIONS)
            there = read_parquet_or_empty(m.spark, target, sound[name].schema)
            kept = there.count()
            assert kept == audit.written
            if kind == "sound" and kept:
                lake[name] = there.drop("row_bucket")
            rows += [(kind, name, rule, column, severity, n, kept)
                     for rule, column, severity, n in audit.rules]
    return m.spark.createDataFrame(
        rows, "batch string, table_name string, rule string, column_name string, "
              "severity string, failing_rows long, lake_rows long")


def gold_export(m) -> dict[str, DataFrame]:
    """Every gold mart written as Parquet and read back; an absent table is skipped.

    The ledger and the growth mart, which other marts read, are read from their exported
    tables, so they are written once.
    """
    path, out = scratch_path(m.spark, "gold-export"), Exported(m.spark)
    for name in ("position_lots", "investment_growth"):
        out.add(export_gold(m.spark, {name: m.table(name)}, path))
        m.cache[name] = out[name]
    rest = {n: df for n, df in m.gold().items() if n not in out}
    out.add(export_gold(m.spark, rest | {"absent_table": None}, path))
    return out


def gold_rows(exported: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_text) of every exported row: its values in column order as text."""
    def text(df: DataFrame) -> Column:
        return F.concat_ws("|", *[F.coalesce(
            (F.col(c).cast("decimal(38,4)") if t == "double" else
             F.col(c).cast("date") if t.startswith("timestamp") else F.col(c)).cast("string"),
            F.lit("-")) for c, t in df.dtypes])

    return reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("table_name"), text(df).alias("row_text"))
        for n, df in exported.items()])
