"""Independent SQL statements of every registered query, runnable by DuckDB.

The correctness gate runs each ``queries()`` entry in Spark and the matching
statement here in DuckDB over the same parquet tables.  The statements restate
the semantics directly in SQL (arg_min dedup, list fold of the ledger, native
as-of joins) instead of mirroring the Spark plans, so agreement is a real check.

Named CTEs are defined once below; ``sql(...)`` assembles the WITH clause a
final SELECT needs, dependencies first.
"""

from __future__ import annotations

import re

# --- domain views derived from the driver tables (see sources/driver_tables.py)
CTES: dict[str, str] = {}

CTES["raw_bank_base"] = """
  SELECT CAST(o_orderdate AS DATE) AS transaction_date,
         'ORDER ' || CAST(o_orderkey AS VARCHAR) AS description,
         CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS amount,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS category_raw,
         CASE WHEN o_custkey % 2 = 0 THEN 'amex' ELSE 'chase' END AS source,
         (CASE WHEN o_custkey % 2 = 0 THEN 'amex' ELSE 'chase' END) || '.card'
           || CAST(o_custkey // 1000 AS VARCHAR) || '_'
           || CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR) || '.csv' AS source_file,
         o_orderkey AS pos,
         TIMESTAMP '2026-01-05 13:00:00' AS ingested_at
  FROM orders"""

CTES["raw_bank"] = """
  SELECT * FROM raw_bank_base
  UNION ALL
  SELECT transaction_date, description, amount, category_raw, source,
         regexp_replace(source_file, '\\.csv$', '_redownload.csv'), pos,
         TIMESTAMP '2026-01-06 13:00:00'
  FROM raw_bank_base WHERE transaction_date >= DATE '2000-01-01'"""

CTES["raw_trades_base"] = """
  SELECT CAST(l_shipdate AS DATE) AS trade_date,
         'ACCT-' || CAST(l_suppkey AS VARCHAR) AS account,
         CASE WHEN l_returnflag = 'N' THEN 'YOU BOUGHT'
              WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'DIVIDEND REINVESTMENT'
              WHEN l_returnflag = 'A' THEN 'REINVESTMENT'
              ELSE 'YOU SOLD' END AS action,
         'P' || CAST(l_partkey AS VARCHAR) AS symbol,
         'USD' AS currency,
         CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS price,
         CASE WHEN l_returnflag = 'R' THEN l_quantity / 10.0 ELSE l_quantity END AS quantity,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END AS source,
         (CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END) || '-ira'
           || CAST(l_suppkey // 100 AS VARCHAR) || '_' || CAST(year(CAST(l_shipdate AS DATE)) AS VARCHAR) || '.csv' AS source_file,
         (l_orderkey * 8 + l_linenumber) * 2 AS pos,
         TIMESTAMP '2026-01-05 13:00:00' AS ingested_at
  FROM lineitem
  UNION ALL
  SELECT CAST(l_shipdate AS DATE), 'ACCT-' || CAST(l_suppkey AS VARCHAR), 'DIVIDEND RECEIVED',
         'P' || CAST(l_partkey AS VARCHAR), 'USD', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
         l_extendedprice * l_tax,
         CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END,
         (CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END) || '-ira'
           || CAST(l_suppkey // 100 AS VARCHAR) || '_' || CAST(year(CAST(l_shipdate AS DATE)) AS VARCHAR) || '.csv',
         (l_orderkey * 8 + l_linenumber) * 2 + 1, TIMESTAMP '2026-01-05 13:00:00'
  FROM lineitem WHERE l_discount = 0.10
  UNION ALL
  SELECT CAST(l_shipdate AS DATE), 'ACCT-' || CAST(l_suppkey AS VARCHAR), 'INTEREST EARNED',
         CAST(NULL AS VARCHAR), 'USD', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), l_quantity,
         CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END,
         (CASE WHEN l_linestatus = 'F' THEN 'fidelity' ELSE 'vanguard' END) || '-ira'
           || CAST(l_suppkey // 100 AS VARCHAR) || '_' || CAST(year(CAST(l_shipdate AS DATE)) AS VARCHAR) || '.csv',
         (l_orderkey * 8 + l_linenumber) * 2 + 1, TIMESTAMP '2026-01-05 13:00:00'
  FROM lineitem WHERE l_discount = 0.0"""

CTES["raw_trades"] = """
  SELECT * FROM raw_trades_base
  UNION ALL
  SELECT trade_date, account, action, symbol, currency, price, quantity, amount, source,
         regexp_replace(source_file, '\\.csv$', '_redownload.csv'), pos,
         TIMESTAMP '2026-01-06 13:00:00'
  FROM raw_trades_base WHERE trade_date >= DATE '2001-01-01'"""

CTES["raw_prices_base"] = """
  SELECT price_date, symbol, min(unit) + 1 AS open, max(unit) + 2 AS high, min(unit) AS low,
         max(unit) AS close, max(unit) - 1 AS adj_close, CAST(sum(qty) AS BIGINT) AS volume,
         'USD' AS currency, 'stock_prices' AS source,
         'prices_' || strftime(price_date, '%Y-%m') || '.csv' AS source_file,
         TIMESTAMP '2026-01-05 13:00:00' AS ingested_at
  FROM (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS symbol,
               CAST(l_shipdate AS DATE) + CAST(l_linenumber % 5 AS INTEGER) AS price_date,
               CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS unit,
               l_quantity AS qty
        FROM lineitem)
  GROUP BY symbol, price_date"""

CTES["raw_prices"] = """
  SELECT * FROM raw_prices_base
  UNION ALL
  SELECT price_date, symbol, open, high, low, close, adj_close, volume, currency, source,
         regexp_replace(source_file, '\\.csv$', '_redownload.csv'),
         TIMESTAMP '2026-01-06 13:00:00'
  FROM raw_prices_base WHERE price_date >= DATE '2001-06-01'"""


def _txt(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), '∅')"


_BANK_BASE = " || '|' || ".join(_txt(e) for e in (
    "transaction_date", "description", "CAST(amount AS DECIMAL(18,2))"))
_TRADE_BASE = " || '|' || ".join(_txt(e) for e in (
    "trade_date", "account", "action", "symbol", "CAST(quantity AS DECIMAL(18,6))",
    "CAST(price AS DECIMAL(18,4))", "CAST(amount AS DECIMAL(18,2))"))
_PRICE_BASE = " || '|' || ".join(_txt(e) for e in (
    "price_date", "symbol", "CAST(close AS DECIMAL(18,4))"))

CTES["bank_keyed"] = f"""
  SELECT *, {_BANK_BASE} AS base_key,
         split_part(regexp_replace(source_file, '\\.[^.]*$', ''), '_', 1) AS source_account_hint
  FROM raw_bank"""

CTES["bronze_bank"] = """
  SELECT * EXCLUDE (base_key, occ),
         sha256(base_key || '|' || CAST(occ AS VARCHAR)) AS row_hash,
         strftime(transaction_date, '%Y-%m') AS year_month
  FROM (SELECT *, row_number() OVER (PARTITION BY source_file, base_key ORDER BY pos) - 1 AS occ
        FROM bank_keyed)"""

CTES["trades_keyed"] = f"""
  SELECT *, {_TRADE_BASE} AS base_key,
         split_part(regexp_replace(source_file, '\\.[^.]*$', ''), '_', 1) AS source_account_hint
  FROM raw_trades"""

CTES["bronze_trades"] = """
  SELECT * EXCLUDE (base_key, occ),
         sha256(base_key || '|' || CAST(occ AS VARCHAR)) AS row_hash,
         strftime(trade_date, '%Y-%m') AS year_month
  FROM (SELECT *, row_number() OVER (PARTITION BY source_file, base_key ORDER BY pos) - 1 AS occ
        FROM trades_keyed)"""

CTES["bronze_prices"] = f"""
  SELECT *, sha256({_PRICE_BASE}) AS row_hash, strftime(price_date, '%Y-%m') AS year_month
  FROM raw_prices"""

# --- silver
CTES["stg_transactions"] = """
  SELECT unnest(arg_min(struct_pack(transaction_date := CAST(transaction_date AS DATE), description := description, amount := CAST(amount AS DECIMAL(18,2)), category_raw := category_raw, source_account_hint := source_account_hint, source := source), ingested_at)), row_hash
  FROM bronze_bank GROUP BY row_hash"""

CTES["stg_trades"] = """
  SELECT unnest(arg_min(struct_pack(trade_date := CAST(trade_date AS DATE), account := account, action := action, symbol := symbol, currency := currency, price := CAST(price AS DECIMAL(18,4)), quantity := CAST(quantity AS DECIMAL(18,6)), amount := CAST(amount AS DECIMAL(18,2)), source_account_hint := source_account_hint, source := source), ingested_at)), row_hash
  FROM bronze_trades GROUP BY row_hash"""

CTES["stg_stock_prices"] = """
  SELECT unnest(arg_min(struct_pack(price_date := CAST(price_date AS DATE), symbol := symbol, open := CAST(open AS DECIMAL(18,4)), high := CAST(high AS DECIMAL(18,4)), low := CAST(low AS DECIMAL(18,4)), close := CAST(close AS DECIMAL(18,4)), adj_close := CAST(adj_close AS DECIMAL(18,4)), volume := CAST(volume AS BIGINT), currency := currency), ingested_at)), row_hash
  FROM bronze_prices GROUP BY row_hash"""

# --- gold
CTES["monthly_spending"] = """
  SELECT month, category, spent AS total_spent, n AS transaction_count,
         sum(spent) OVER (PARTITION BY month) AS total_spent_month,
         round(spent / nullif(sum(spent) OVER (PARTITION BY month), 0) * 100, 1)
           AS pct_of_month_spend
  FROM (SELECT month, category, sum(spend) AS spent, count(spend) AS n
        FROM (SELECT date_trunc('month', transaction_date) AS month,
                     ifnull(category_raw, 'Uncategorized') AS category,
                     CASE WHEN amount > 0 THEN amount END AS spend
              FROM stg_transactions)
        GROUP BY ALL)
  WHERE n > 0"""

CTES["trade_rows"] = """
  SELECT row_number() OVER (PARTITION BY symbol, source
                            ORDER BY trade_date, amount, row_hash) AS rn,
         trade_date, symbol, source, account, action, quantity, price, amount, row_hash,
         (action ILIKE '%bought%' OR action ILIKE '%reinvestment%') AS adds,
         action ILIKE '%sold%' AS sells
  FROM stg_trades
  WHERE action ILIKE '%bought%' OR action ILIKE '%sold%' OR action ILIKE '%reinvestment%'"""

# One list of trades per ledger, folded from left to right: the state of a trade is
# computed from the last state in the list so far.  A ledger without a full key keeps
# its first trade only.
CTES["ledger_lists"] = """
  SELECT list_slice(trades, 1, CASE WHEN symbol IS NULL OR source IS NULL THEN 1
                                    ELSE len(trades) END) AS trades
  FROM (SELECT symbol, source, list([{
          'rn': rn, 'trade_date': trade_date, 'symbol': symbol, 'source': source,
          'account': account, 'action': action, 'quantity': quantity, 'price': price,
          'amount': amount, 'adds': adds, 'sells': sells,
          'shares': CAST(if(adds, quantity, 0) AS DECIMAL(18,6)),
          'cost': CAST(if(adds, quantity * price, 0) AS DECIMAL(18,2)),
          'gain': CAST(0 AS DECIMAL(18,2))}] ORDER BY rn) AS trades
        FROM trade_rows GROUP BY symbol, source)"""

CTES["position_lots"] = """
  SELECT t.rn, t.trade_date, t.symbol, t.source, t.account, t.action, t.quantity, t.price,
         t.amount, t.shares AS shares_held, t.cost AS cost_basis, t.gain AS realized_gain
  FROM (SELECT unnest(list_reduce(trades, lambda done, x: list_append(done, {
          'rn': x[1].rn, 'trade_date': x[1].trade_date, 'symbol': x[1].symbol,
          'source': x[1].source, 'account': x[1].account, 'action': x[1].action,
          'quantity': x[1].quantity, 'price': x[1].price, 'amount': x[1].amount,
          'adds': x[1].adds, 'sells': x[1].sells,
          'shares': CAST(done[-1].shares + x[1].quantity * if(x[1].adds, 1, if(x[1].sells, -1, 0))
                         AS DECIMAL(18,6)),
          'cost': CAST(if(x[1].adds,
                          CAST(done[-1].cost + x[1].quantity * x[1].price AS DOUBLE),
                          CAST(done[-1].cost AS DOUBLE)
                          - if(x[1].sells, CAST(x[1].quantity AS DOUBLE)
                               * (done[-1].cost / nullif(done[-1].shares, 0)), 0))
                       AS DECIMAL(18,2)),
          'gain': CAST(if(x[1].sells,
                          CAST(x[1].amount AS DOUBLE) - CAST(x[1].quantity AS DOUBLE)
                          * (done[-1].cost / nullif(done[-1].shares, 0)), 0)
                       AS DECIMAL(18,2))}))) AS t
        FROM ledger_lists)"""

CTES["realized_gains"] = """
  SELECT trade_date, symbol, source, account, quantity AS shares_sold, price AS sale_price,
         amount AS proceeds, realized_gain
  FROM position_lots WHERE action ILIKE '%sold%'"""

CTES["latest_position"] = """
  SELECT symbol, source, max(trade_date) AS trade_date,
         unnest(arg_max({'rn': rn, 'account': account, 'shares_held': shares_held,
                         'cost_basis': cost_basis}, (trade_date, rn)))
  FROM position_lots GROUP BY symbol, source"""

CTES["latest_price"] = """
  SELECT symbol, arg_max(close, (price_date, row_hash)) AS current_price,
         max(price_date) AS price_date
  FROM stg_stock_prices GROUP BY symbol"""

CTES["unrealized_gains"] = """
  SELECT symbol, source, account, shares_held, cost_basis,
         round(cost_basis / nullif(shares_held, 0), 4) AS avg_cost_per_share, current_price,
         latest_price.price_date AS priced_as_of,
         CAST(round(current_price * shares_held, 2) AS DECIMAL(18,2)) AS market_value,
         CAST(round(current_price * shares_held - cost_basis, 2) AS DECIMAL(27,2))
           AS unrealized_gain
  FROM (SELECT * EXCLUDE (trade_date, rn) FROM latest_position WHERE shares_held > 0)
  LEFT JOIN latest_price USING (symbol)"""

CTES["realized_by_position"] = """
  SELECT symbol, source, CAST(sum(realized_gain) AS DECIMAL(38,2)) AS total_realized_gain
  FROM realized_gains GROUP BY symbol, source"""

CTES["investment_growth"] = """
  SELECT symbol, source, CAST(gain AS DECIMAL(38,2)) AS total_realized_gain,
         CAST(cost AS DECIMAL(18,2)) AS current_cost_basis,
         CAST(value AS DECIMAL(18,2)) AS current_market_value,
         CAST(open_gain AS DECIMAL(27,2)) AS unrealized_gain,
         CAST(gain + open_gain AS DECIMAL(38,2)) AS total_gain,
         round((gain + open_gain) / nullif(cost, 0) * 100, 2) AS roe_pct
  FROM (SELECT symbol, source, sum(gain) AS gain, sum(cost) AS cost, sum(value) AS value,
               sum(open_gain) AS open_gain
        FROM (SELECT symbol, source, total_realized_gain AS gain, 0.00 AS cost, 0.00 AS value,
                     0.00 AS open_gain, 'closed' AS side FROM realized_by_position
              UNION ALL BY NAME
              SELECT symbol, source, 0.00 AS gain, cost_basis AS cost,
                     ifnull(market_value, 0) AS value, ifnull(unrealized_gain, 0) AS open_gain,
                     'open' AS side FROM unrealized_gains)
        GROUP BY symbol, source,
                 CASE WHEN symbol IS NULL OR source IS NULL THEN side END)"""

CTES["portfolio_roe_summary"] = """
  SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source,
         CAST(sum(total_realized_gain) AS DECIMAL(38,2)) AS total_realized_gain,
         CAST(sum(current_cost_basis) AS DECIMAL(38,2)) AS current_cost_basis,
         CAST(sum(current_market_value) AS DECIMAL(38,2)) AS current_market_value,
         CAST(sum(unrealized_gain) AS DECIMAL(38,2)) AS unrealized_gain,
         CAST(sum(total_gain) AS DECIMAL(38,2)) AS total_gain,
         round(sum(total_gain) / nullif(sum(current_cost_basis), 0) * 100, 2) AS roe_pct
  FROM investment_growth GROUP BY GROUPING SETS ((), (source))"""

# --- wealth summary
CTES["calendar_spine"] = """
  SELECT transaction_date AS d FROM stg_transactions
  UNION
  SELECT price_date FROM stg_stock_prices"""

CTES["cash_running"] = """
  SELECT transaction_date,
         CAST(sum(day_amount) OVER (ORDER BY transaction_date
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DECIMAL(38,2)) AS cash_balance
  FROM (SELECT transaction_date, sum(amount) AS day_amount
        FROM stg_transactions GROUP BY transaction_date)"""

CTES["running_holdings"] = """
  SELECT trade_date, symbol,
         CAST(sum(day_qty) OVER (PARTITION BY symbol ORDER BY trade_date
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DECIMAL(38,6)) AS shares_held
  FROM (SELECT symbol, trade_date,
               sum(CASE WHEN action ILIKE '%bought%' OR action ILIKE '%reinvestment%' THEN quantity
                        WHEN action ILIKE '%sold%' THEN -quantity
                        ELSE 0 END) AS day_qty
        FROM stg_trades
        WHERE (action ILIKE '%bought%' OR action ILIKE '%sold%' OR action ILIKE '%reinvestment%')
          AND symbol IS NOT NULL
        GROUP BY symbol, trade_date)"""

CTES["holdings_asof"] = """
  SELECT p.price_date, p.symbol, p.close, h.shares_held
  FROM stg_stock_prices p
  ASOF LEFT JOIN running_holdings h
    ON h.symbol = p.symbol AND p.price_date >= h.trade_date"""

CTES["portfolio_value_by_day"] = """
  SELECT price_date AS as_of_date,
         CAST(sum(coalesce(shares_held, 0) * close) AS DECIMAL(38,10)) AS portfolio_value
  FROM holdings_asof GROUP BY price_date"""

CTES["forward_fill"] = """
  SELECT days.d AS as_of_date, c.cash_balance, v.portfolio_value
  FROM calendar_spine AS days
  ASOF LEFT JOIN cash_running AS c ON days.d >= c.transaction_date
  ASOF LEFT JOIN portfolio_value_by_day AS v ON days.d >= v.as_of_date"""

CTES["wealth_summary"] = """
  SELECT as_of_date, CAST(cash AS DECIMAL(38,2)) AS cash_balance,
         CAST(held AS DECIMAL(38,10)) AS portfolio_value,
         CAST(cash + held AS DECIMAL(38,10)) AS net_worth,
         CAST(before AS DECIMAL(38,10)) AS prior_net_worth,
         round((cash + held - before) / nullif(before, 0) * 100, 2) AS day_over_day_roi_pct
  FROM (SELECT *, any_value(cash + held) OVER (ORDER BY as_of_date
                  ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS before
        FROM (SELECT as_of_date, ifnull(cash_balance, 0) AS cash,
                     ifnull(portfolio_value, 0) AS held FROM forward_fill))"""


_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [t for t in dict.fromkeys(_NAME_RE.findall(body)) if t in CTES and t != name]


def sql(final_select: str, given: frozenset[str] | set[str] = frozenset()) -> str:
    """WITH clause holding every CTE the final SELECT (transitively) uses.

    Names in ``given`` are left out: the caller provides them as tables.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in given:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for t in dict.fromkeys(_NAME_RE.findall(final_select)):
        if t in CTES and t not in given:
            visit(t)
    if not order:
        return final_select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + final_select


BANK_BRONZE_OUT = ("transaction_date, description, amount, category_raw, source_account_hint, "
                   "source, source_file, pos, row_hash, year_month")

FINAL: dict[str, str] = {
    "row_hash_occurrence": f"SELECT {BANK_BRONZE_OUT} FROM bronze_bank",
    "stg_transactions_dedup": "SELECT * FROM stg_transactions",
    "stg_trades_dedup": "SELECT * FROM stg_trades",
    "stg_prices_dedup": "SELECT * FROM stg_stock_prices",
    "monthly_spending": """
      SELECT month, category, CAST(total_spent AS DECIMAL(38,2)) AS total_spent,
             CAST(transaction_count AS BIGINT) AS transaction_count,
             CAST(total_spent_month AS DECIMAL(38,2)) AS total_spent_month, pct_of_month_spend
      FROM monthly_spending""",
    "trade_sequence": "SELECT symbol, source, trade_date, amount, row_hash, rn FROM trade_rows",
    "position_lots": "SELECT * FROM position_lots",
    "realized_gains": "SELECT * FROM realized_gains",
    "latest_position": "SELECT * FROM latest_position",
    "latest_price": "SELECT * FROM latest_price",
    "unrealized_gains": "SELECT * FROM unrealized_gains",
    "realized_by_position": "SELECT * FROM realized_by_position",
    "investment_growth": "SELECT * FROM investment_growth",
    "portfolio_roe_summary": "SELECT * FROM portfolio_roe_summary",
    "calendar_spine": "SELECT d FROM calendar_spine",
    "cash_running": "SELECT * FROM cash_running",
    "running_holdings": "SELECT * FROM running_holdings",
    "holdings_asof": "SELECT * FROM holdings_asof",
    "portfolio_value_by_day": "SELECT * FROM portfolio_value_by_day",
    "forward_fill": "SELECT * FROM forward_fill",
    "wealth_summary": "SELECT * FROM wealth_summary",
}

CTES["watchlist"] = """
  SELECT upper(trim(line)) AS symbol
  FROM (SELECT CASE WHEN p_type = 'ECONOMY' THEN '# ' ELSE '' END
               || ' p' || CAST(p_partkey AS VARCHAR) || ' ' AS line
        FROM part)
  WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')"""

CTES["ticker_universe"] = """
  SELECT symbol FROM bronze_trades WHERE symbol IS NOT NULL AND symbol <> ''
  UNION SELECT symbol FROM watchlist
  UNION SELECT 'NVDA' UNION SELECT 'COIN'"""

FINAL["year_month_partition_counts"] = """
  SELECT 'bank_transactions' AS dataset, source, year_month, count(*) AS rows
  FROM bronze_bank GROUP BY source, year_month
  UNION ALL
  SELECT 'trades', source, year_month, count(*) FROM bronze_trades GROUP BY source, year_month
  UNION ALL
  SELECT 'stock_prices', source, year_month, count(*) FROM bronze_prices
  GROUP BY source, year_month"""
FINAL["ticker_universe"] = "SELECT symbol FROM ticker_universe"
FINAL["missing_symbols_anti"] = """
  SELECT u.symbol FROM ticker_universe u
  WHERE u.symbol NOT IN (SELECT symbol FROM raw_prices WHERE symbol IS NOT NULL)"""
FINAL["refresh_windows"] = """
  SELECT kind, start_date, end_date, count(p.price_date) AS rows
  FROM (SELECT 'backfill' AS kind, min(trade_date) AS start_date, DATE '2001-12-31' AS end_date
        FROM bronze_trades
        UNION ALL SELECT 'days', DATE '2001-12-26', DATE '2001-12-31'
        UNION ALL SELECT 'start', DATE '2001-11-05', DATE '2001-12-31') w
  LEFT JOIN raw_prices p ON p.price_date >= start_date AND p.price_date <= end_date
  GROUP BY kind, start_date, end_date"""
FINAL["backfill_bounds"] = """
  SELECT min(trade_date) AS start_date, DATE '2001-12-31' AS end_date FROM bronze_trades"""
FINAL["sign_violations"] = """
  SELECT trade_date, account, action, symbol, amount, row_hash,
         'buy_amount_not_negative' AS rule
  FROM bronze_trades
  WHERE (action ILIKE '%bought%' OR action ILIKE '%reinvestment%') AND amount >= 0
  UNION ALL
  SELECT trade_date, account, action, symbol, amount, row_hash,
         'sell_or_dividend_amount_not_positive'
  FROM bronze_trades
  WHERE (action ILIKE '%sold%' OR action ILIKE '%dividend%') AND amount <= 0"""


def _report(table: str, relation: str, lines: str) -> str:
    """One row per line ``rule column severity = count expression`` over a relation."""
    out = []
    for line in lines.strip().splitlines():
        head, expr = line.split(" = ", 1)
        rule, column, severity = head.split()
        name = "CAST(NULL AS VARCHAR)" if column == "-" else f"'{column}'"
        out.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule, {name} AS column_name, "
                   f"'{severity}' AS severity, CAST({expr} AS BIGINT) AS failing_rows "
                   f"FROM {relation}")
    return "\nUNION ALL\n".join(out)


_LEDGER = "regexp_matches(action, 'bought|sold|reinvestment', 'i')"

def _twice(column: str, table: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column} "
            f"HAVING count({column}) > 1))")


# Fixed text, not derived from the rule lists of operators/quality.py.
FINAL["quality_report"] = "\nUNION ALL\n".join([
    _report("stg_trades", "stg_trades", f"""
not_null trade_date error = count(*) - count(trade_date)
not_null account error = count(*) - count(account)
not_null action error = count(*) - count(action)
not_null symbol error = count_if({_LEDGER} AND symbol IS NULL)
not_null amount error = count(*) - count(amount)
not_null source error = count(*) - count(source)
accepted_values source error = count_if(source <> 'fidelity' AND source <> 'vanguard')
not_null row_hash error = count(*) - count(row_hash)
unique row_hash error = any_value({_twice('row_hash', 'stg_trades')})"""),
    _report("stg_transactions", "stg_transactions", f"""
not_null transaction_date error = count(*) - count(transaction_date)
not_null description error = count(*) - count(description)
not_null amount error = count(*) - count(amount)
not_null source error = count(*) - count(source)
accepted_values source error = count_if(source <> 'amex' AND source <> 'chase')
not_null row_hash error = count(*) - count(row_hash)
unique row_hash error = any_value({_twice('row_hash', 'stg_transactions')})"""),
    _report("stg_stock_prices", "stg_stock_prices", f"""
not_null price_date error = count(*) - count(price_date)
not_null symbol error = count(*) - count(symbol)
not_null close error = count(*) - count(close)
not_null row_hash error = count(*) - count(row_hash)
unique row_hash error = any_value({_twice('row_hash', 'stg_stock_prices')})"""),
    _report("wealth_summary", "wealth_summary", f"""
not_null as_of_date error = count(*) - count(as_of_date)
unique as_of_date error = any_value({_twice('as_of_date', 'wealth_summary')})
not_null portfolio_value error = count(*) - count(portfolio_value)"""),
    _report("monthly_spending", "monthly_spending", """
not_null month error = count(*) - count(month)
not_null category error = count(*) - count(category)
not_null total_spent error = count(*) - count(total_spent)"""),
    _report("position_lots", "position_lots", """
not_null symbol error = count(*) - count(symbol)
not_null source error = count(*) - count(source)
not_null shares_held error = count(*) - count(shares_held)
accepted_range shares_held error = count_if(shares_held < 0)"""),
    _report("realized_gains", "realized_gains", """
not_null symbol error = count(*) - count(symbol)
not_null source error = count(*) - count(source)"""),
    _report("unrealized_gains", "unrealized_gains", """
not_null symbol error = count(*) - count(symbol)
not_null source error = count(*) - count(source)
accepted_range shares_held error = count_if(shares_held <= 0)"""),
    _report("investment_growth", "investment_growth", """
not_null symbol error = count(*) - count(symbol)
not_null source error = count(*) - count(source)"""),
    _report("portfolio_roe_summary", "portfolio_roe_summary", f"""
not_null source error = count(*) - count(source)
unique source error = any_value({_twice('source', 'portfolio_roe_summary')})"""),
])


def _ingest(bank: str, trades: str, prices: str) -> str:
    buys, outs = "'bought|reinvestment'", "'sold|dividend'"
    return "\nUNION ALL\n".join([
        _report("bank_transactions", bank, f"""
non_empty - error = if(count(*) = 0, 1, 0)
not_null transaction_date error = count_if(transaction_date IS NULL)
numeric amount error = count_if(try_cast(amount AS DOUBLE) IS NULL)
duplicates row_hash warn = count(*) - any_value((SELECT count(*) FROM (SELECT DISTINCT row_hash FROM {bank})))
max_span transaction_date warn = if(max(transaction_date) - min(transaction_date) > 35, 1, 0)"""),
        _report("trades", trades, f"""
non_empty - error = if(count(*) = 0, 1, 0)
not_null trade_date error = count_if(trade_date IS NULL)
numeric amount error = count_if(try_cast(amount AS DOUBLE) IS NULL)
not_null price warn = count_if({_LEDGER} AND price IS NULL)
not_null quantity warn = count_if({_LEDGER} AND quantity IS NULL)
accepted_range amount warn = count_if(regexp_matches(action, {buys}, 'i') AND amount >= 0)
accepted_range amount warn = count_if(regexp_matches(action, {outs}, 'i') AND amount <= 0)
duplicates row_hash warn = count(*) - any_value((SELECT count(*) FROM (SELECT DISTINCT row_hash FROM {trades})))"""),
        _report("stock_prices", prices, f"""
non_empty - error = if(count(*) = 0, 1, 0)
not_null close error = count_if(close IS NULL)
duplicates row_hash warn = count(*) - any_value((SELECT count(*) FROM (SELECT DISTINCT row_hash FROM {prices})))
accepted_range price_date warn = count_if(price_date < DATE '1992-01-01' OR price_date > DATE '2001-12-31')"""),
    ])


FINAL["ingest_report"] = _ingest("bronze_bank", "bronze_trades", "bronze_prices")

# --- damaged batches (the same damage as plans/roundtrips.py, said in SQL)
CTES["damaged_bank"] = """
  SELECT * REPLACE (
    CASE WHEN pos % 11 = 0 THEN '$' || CAST(amount AS VARCHAR)
         WHEN pos % 13 <> 0 THEN CAST(amount AS VARCHAR) END AS amount,
    CASE WHEN pos % 7 <> 0 THEN transaction_date END AS transaction_date,
    CASE WHEN pos % 5 = 0 THEN 'same' ELSE row_hash END AS row_hash)
  FROM bronze_bank"""
CTES["damaged_trades"] = """
  SELECT * REPLACE (
    CASE WHEN pos % 17 = 0 THEN NULL WHEN pos % 3 = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN pos % 7 <> 0 THEN trade_date END AS trade_date,
    CASE WHEN pos % 19 <> 0 THEN price END AS price,
    CASE WHEN pos % 23 <> 0 THEN quantity END AS quantity)
  FROM bronze_trades"""
CTES["damaged_prices"] = """
  SELECT * REPLACE (
    CASE WHEN day(price_date) <> 13 THEN close END AS close,
    CASE WHEN day(price_date) = 14 THEN DATE '1980-01-01' ELSE price_date END AS price_date)
  FROM bronze_prices"""
FINAL["damaged_ingest_report"] = "\nUNION ALL\n".join([
    _ingest("damaged_bank", "damaged_trades", "damaged_prices"),
    _report("empty_upload", "(SELECT 1)", """
non_empty - error = 1
not_null transaction_date error = 0
numeric amount error = 0
duplicates row_hash warn = 0
max_span transaction_date warn = 0""")])
_LAKE_ROWS = {"bank_transactions": "bronze_bank", "trades": "bronze_trades",
              "stock_prices": "bronze_prices"}
FINAL["publish_report"] = f"""
  SELECT 'sound' AS batch, *, CASE table_name
      {" ".join(f"WHEN '{d}' THEN (SELECT count(*) FROM {t})" for d, t in _LAKE_ROWS.items())}
    END AS lake_rows
  FROM ({FINAL["ingest_report"]})
  UNION ALL
  SELECT 'damaged', *, 0 FROM ({_ingest("damaged_bank", "damaged_trades", "damaged_prices")})"""
FINAL["null_price_or_quantity"] = f"""
  SELECT trade_date, account, action, symbol, row_hash FROM damaged_trades
  WHERE {_LEDGER} AND price + quantity IS NULL"""
FINAL["statement_span"] = """
  SELECT lo AS min_date, hi AS max_date, CAST(hi - lo AS INTEGER) AS days_span,
         CASE WHEN hi = lo THEN 'note: single day'
              WHEN hi - lo > 35 THEN 'warning: wider than one statement' END AS finding
  FROM (SELECT min(transaction_date) AS lo, max(transaction_date) AS hi FROM raw_bank)"""
FINAL["price_date_bounds"] = """
  SELECT price_date, symbol, close, row_hash FROM bronze_prices
  WHERE NOT price_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"""

_ACCOUNT = "split_part(regexp_replace(source_file, '\\.[^.]*$', ''), '_', 1)"
FINAL["source_roundtrip"] = f"""
  SELECT source, transaction_date, description, amount, category_raw,
         {_ACCOUNT} AS source_account_hint,
         CASE WHEN source = 'amex' THEN 'HOLDER ' || CAST(pos % 7 AS VARCHAR) END AS card_member,
         CASE WHEN source = 'amex' THEN CAST(-pos AS VARCHAR) END AS account_number
  FROM raw_bank"""
for _broker in ("fidelity", "vanguard"):
    FINAL[f"{_broker}_roundtrip"] = f"""
  SELECT trade_date, account, action, symbol, currency, price, quantity, amount,
         {_ACCOUNT} AS source_account_hint, source
  FROM raw_trades WHERE source = '{_broker}'"""
CTES["uneven"] = """
  SELECT *, CAST(regexp_extract(source_file, '_([0-9]{4})', 1) AS INTEGER) % 3 AS kind,
         max(day(transaction_date)) OVER (PARTITION BY source_file) > 12 AS told
  FROM raw_bank WHERE source = 'chase'"""
FINAL["header_audit"] = """
  SELECT source_file, CASE kind
           WHEN 0 THEN 'Transaction Date|Post Date|Description|Category|Type|Amount'
           WHEN 1 THEN 'Transaction Date|Description|Amount'
           ELSE 'Transaction Date|Description|Category|Amount|Memo' END AS found,
         CASE kind WHEN 1 THEN 'Category' ELSE '' END AS missing,
         CASE kind WHEN 0 THEN 'Post Date|Type' WHEN 1 THEN '' ELSE 'Memo' END AS extra,
         count(*) AS records,
         CASE WHEN NOT told THEN 'ambiguous' WHEN kind = 0 THEN 'M/d' ELSE 'd/M' END AS date_order
  FROM uneven GROUP BY source_file, kind, told"""
FINAL["uneven_roundtrip"] = """
  SELECT source_file,
         CASE WHEN kind = 0 OR told THEN transaction_date
              ELSE make_date(year(transaction_date), day(transaction_date),
                             month(transaction_date)) END AS transaction_date,
         description, amount, CASE WHEN kind <> 1 THEN category_raw END AS category_raw
  FROM uneven"""
FINAL["price_grid"] = """
  SELECT CAST(l_shipdate AS DATE) AS price_date,
         repeat(chr(CAST(64 + l_linenumber AS INTEGER)), 3) AS symbol,
         min(unit) + 1 AS open, max(unit) + 2 AS high, min(unit) AS low, max(unit) AS close,
         max(unit) - 1 AS adj_close, CAST(sum(l_quantity) AS BIGINT) AS volume,
         'USD' AS currency, 'stock_prices' AS source
  FROM (SELECT *, CAST(floor(l_extendedprice / l_quantity) AS DOUBLE) AS unit FROM lineitem)
  GROUP BY ALL"""
FINAL["watchlist_file"] = "SELECT symbol FROM watchlist"
FINAL["materialised_spending"] = FINAL["monthly_spending"]
FINAL["lake_trades"] = "SELECT * FROM stg_trades"
FINAL["lake_prices"] = "SELECT * FROM stg_stock_prices"
FINAL["running_cost_stream"] = FINAL["position_lots"]
FINAL["incremental_silver"] = FINAL["stg_trades_dedup"]
FINAL["incremental_spending"] = FINAL["monthly_spending"]
FINAL["incremental_wealth"] = FINAL["wealth_summary"]
FINAL["monthly_spending_ranked"] = f"""
  SELECT *, row_number() OVER (ORDER BY month NULLS LAST, total_spent DESC NULLS LAST,
                                        category NULLS LAST) AS place
  FROM ({FINAL["monthly_spending"]})"""
for _mart, _order in (
        ("position_lots", "symbol NULLS LAST, source NULLS LAST, trade_date NULLS LAST, rn"),
        ("realized_gains", "trade_date NULLS LAST, symbol NULLS LAST, source NULLS LAST, "
                           "account NULLS LAST, shares_sold NULLS LAST, sale_price NULLS LAST, "
                           "proceeds NULLS LAST, realized_gain NULLS LAST"),
        ("unrealized_gains", "unrealized_gain DESC NULLS LAST, symbol NULLS LAST, "
                             "source NULLS LAST"),
        ("wealth_summary", "as_of_date NULLS LAST")):
    FINAL[f"{_mart}_ranked"] = f"SELECT *, row_number() OVER (ORDER BY {_order}) AS place FROM {_mart}"
FINAL["two_generations"] = """
  SELECT price_date, symbol, CASE WHEN year_month < '1998-01' THEN open END AS open, high, close,
         CASE WHEN year_month >= '1998-01' THEN adj_close END AS adj_close, volume, row_hash,
         year_month
  FROM bronze_prices"""
FINAL["catalog_lots"] = FINAL["position_lots"]
FINAL["roe_summary_ranked"] = """
  SELECT *, 1 + (SELECT count(*) FROM portfolio_roe_summary AS other
                 WHERE (other.source <> 'ALL', other.source)
                       < (mine.source <> 'ALL', mine.source)) AS place
  FROM portfolio_roe_summary AS mine"""
FINAL["growth_preview"] = """
  SELECT * FROM investment_growth
  ORDER BY total_gain DESC NULLS LAST, symbol NULLS LAST, source NULLS LAST LIMIT 5"""

GOLD_TABLES = ["wealth_summary", "monthly_spending", "position_lots", "realized_gains",
               "unrealized_gains", "investment_growth", "portfolio_roe_summary"]
FINAL["gold_export_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM {t}" for t in GOLD_TABLES)


_GOLD_TEXT = {
    "wealth_summary": "as_of_date cash_balance portfolio_value net_worth prior_net_worth "
                      "day_over_day_roi_pct:f",
    "monthly_spending": "month:d category total_spent:m transaction_count total_spent_month:m "
                        "pct_of_month_spend:f",
    "position_lots": "rn trade_date symbol source account action quantity price amount "
                     "shares_held cost_basis realized_gain",
    "realized_gains": "trade_date symbol source account shares_sold sale_price proceeds "
                      "realized_gain",
    "unrealized_gains": "symbol source account shares_held cost_basis avg_cost_per_share:f "
                        "current_price priced_as_of market_value unrealized_gain",
    "investment_growth": "symbol source total_realized_gain current_cost_basis "
                         "current_market_value unrealized_gain total_gain roe_pct:f",
    "portfolio_roe_summary": "source total_realized_gain current_cost_basis current_market_value "
                             "unrealized_gain total_gain roe_pct:f",
}


def _as_text(column: str) -> str:
    name, _, kind = column.partition(":")
    typed = {"f": f"CAST({name} AS DECIMAL(38,4))", "d": f"CAST({name} AS DATE)",
             "m": f"CAST({name} AS DECIMAL(38,2))"}.get(kind, name)
    return f"ifnull(CAST({typed} AS VARCHAR), '-')"


FINAL["gold_export_contents"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, concat_ws('|', {', '.join(map(_as_text, cols.split()))}) "
    f"AS row_text FROM {t}" for t, cols in _GOLD_TEXT.items())


def oracle_sql() -> dict[str, str]:
    return {name: sql(stmt) for name, stmt in FINAL.items()}
