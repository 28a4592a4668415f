"""Gold marts (G10, G13-G16) and quality checks (V1-V13) on the FIXTURES edge rows."""
import datetime as dt
from decimal import Decimal


from ledgerlake.operators import quality
from ledgerlake.plans import portfolio, spending, wealth
from ledgerlake.plans.present import present
from tests.helpers import duck_with, same as same_rows

D0 = dt.date(2026, 1, 1)
TX = ("transaction_date date, description string, amount decimal(18,2), category_raw string, "
      "source_account_hint string, source string, row_hash string")
PX = ("price_date date, symbol string, open decimal(18,4), high decimal(18,4), low decimal(18,4), "
      "close decimal(18,4), adj_close decimal(18,4), volume bigint, currency string, "
      "row_hash string")
LOTS = ("rn bigint, trade_date date, symbol string, source string, account string, "
        "action string, quantity decimal(18,6), price decimal(18,4), amount decimal(18,2), "
        "shares_held decimal(18,6), cost_basis decimal(18,2), realized_gain decimal(18,2)")


def day(n):
    return D0 + dt.timedelta(days=n)


def tx(spark, rows):
    return spark.createDataFrame(
        [(d, f"T{i}", Decimal(str(a)), c, "card", "amex", f"h{i}") for i, (d, a, c) in
         enumerate(rows)], TX)


def px(spark, rows):
    return spark.createDataFrame(
        [(d, s, None, None, None, Decimal(str(c)), None, 1, "USD", f"p{i}")
         for i, (d, s, c) in enumerate(rows)], PX)


def test_monthly_spending_edges(spark):
    df = tx(spark, [(day(0), 10, None), (day(1), 30, "Food"), (day(2), -5, "Food"),
                    (day(40), 7, "Travel")])
    out = {(r.month.month, r.category): r for r in spending.monthly_spending(df).collect()}
    assert set(out) == {(1, "Uncategorized"), (1, "Food"), (2, "Travel")}
    assert out[(1, "Food")].total_spent == Decimal("30.00")   # the refund is excluded
    assert out[(1, "Food")].pct_of_month_spend == 75.0
    assert out[(2, "Travel")].pct_of_month_spend == 100.0
    assert out[(1, "Food")].total_spent_month == Decimal("40.00")


def lots(spark, rows):
    return spark.createDataFrame(
        [(rn, d, s, src, "A", act, Decimal(str(q)), Decimal(str(p)), Decimal(str(a)),
          Decimal(str(sh)), None if c is None else Decimal(str(c)), Decimal(str(g)))
         for rn, d, s, src, act, q, p, a, sh, c, g in rows], LOTS)


def test_unrealized_growth_and_summary(spark):
    lot = lots(spark, [
        (1, day(0), "AAA", "fidelity", "YOU BOUGHT", 10, 5, -50, 10, 50, 0),
        (1, day(0), "BBB", "fidelity", "YOU BOUGHT", 2, 5, -10, 2, 10, 0),
        (2, day(3), "BBB", "fidelity", "YOU SOLD", 2, 8, 16, 0, 0, 6),     # closed position
        (1, day(1), "CCC", "vanguard", "YOU BOUGHT", 1, 3, -3, 1, 3, 0),   # no price at all
    ])
    prices = px(spark, [(day(0), "AAA", 5), (day(5), "AAA", 7), (day(1), "BBB", 9)])
    u = {(r.symbol, r.source): r for r in portfolio.unrealized_gains(lot, prices).collect()}
    assert set(u) == {("AAA", "fidelity"), ("CCC", "vanguard")}
    assert u[("AAA", "fidelity")].market_value == Decimal("70.00")
    assert u[("AAA", "fidelity")].priced_as_of == day(5)
    assert u[("CCC", "vanguard")].market_value is None
    assert u[("AAA", "fidelity")].avg_cost_per_share == 5.0
    g = portfolio.investment_growth(portfolio.realized_gains(lot),
                                    portfolio.unrealized_gains(lot, prices))
    gr = {(r.symbol, r.source): r for r in g.collect()}
    assert gr[("BBB", "fidelity")].current_cost_basis == 0      # only realized: zero filled
    assert gr[("BBB", "fidelity")].roe_pct is None              # cost 0 -> NULL
    assert gr[("AAA", "fidelity")].total_gain == Decimal("20.00")
    assert gr[("CCC", "vanguard")].unrealized_gain == 0          # no price -> 0
    s = present("portfolio_roe_summary", portfolio.portfolio_roe_summary(g)).collect()
    same = portfolio.growth_of_lots(lot, prices)
    assert sorted(map(repr, same.collect())) == sorted(map(repr, g.collect()))
    assert [r.source for r in s] == ["ALL", "fidelity", "vanguard"]
    assert s[0].total_gain == Decimal("26.00")


def test_roe_summary_on_empty_input_has_one_all_row(spark):
    empty = spark.createDataFrame([], "symbol string, source string, "
                                      "total_realized_gain decimal(38,2), "
                                      "current_cost_basis decimal(18,2), "
                                      "current_market_value decimal(18,2), "
                                      "unrealized_gain decimal(27,2), total_gain decimal(38,2), "
                                      "roe_pct double")
    out = portfolio.portfolio_roe_summary(empty).collect()
    assert len(out) == 1 and out[0].source == "ALL" and out[0].total_gain is None


def test_wealth_summary_fill_and_roi(spark):
    trades = spark.createDataFrame(
        [(day(1), "A", "YOU BOUGHT", "X", "USD", Decimal(2), Decimal(3), Decimal(-6), "a",
          "fidelity", "t1"),
         (day(1), "A", "YOU SOLD", "X", "USD", Decimal(2), Decimal(1), Decimal(2), "a",
          "vanguard", "t2")],
        "trade_date date, account string, action string, symbol string, currency string, "
        "price decimal(18,4), quantity decimal(18,6), amount decimal(18,2), "
        "source_account_hint string, source string, row_hash string")
    t = tx(spark, [(day(0), 0, None), (day(5), 4, None)])     # day 5: weekend-only spend
    p = px(spark, [(day(1), "X", 10), (day(2), "X", 11), (day(0), "X", 9)])
    out = {r.as_of_date: r for r in wealth.wealth_summary(t, trades, p).collect()}
    assert sorted(out) == [day(0), day(1), day(2), day(5)]
    assert out[day(0)].prior_net_worth is None and out[day(0)].day_over_day_roi_pct is None
    assert out[day(1)].portfolio_value == Decimal("20")     # end-of-day net: 3 - 1 = 2 shares
    assert out[day(1)].day_over_day_roi_pct is None          # prior net worth is 0
    assert out[day(5)].portfolio_value == Decimal("22")     # carried from the last price day
    assert out[day(5)].cash_balance == Decimal("4.00")


def test_growth_keeps_null_keys_apart(spark):
    lot = lots(spark, [
        (1, day(0), None, "fidelity", "REINVESTMENT OF SOLD", 2, 5, -10, 2, 10, 0),
        (1, day(0), "AAA", None, "YOU SOLD", 2, 5, 10, 0, 0, 0),
        (1, day(0), "BBB", "vanguard", "YOU BOUGHT", 2, 5, -10, 2, 10, 0)])
    prices = px(spark, [(day(1), "BBB", 6), (day(1), "AAA", 6)])
    one = portfolio.growth_of_lots(lot, prices)
    two = portfolio.investment_growth(portfolio.realized_gains(lot),
                                      portfolio.unrealized_gains(lot, prices))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert one.count() == 4


def test_null_days_come_last_and_once(spark):
    cash = [(day(0), Decimal(1)), (day(2), Decimal(2)), (None, Decimal(100))]
    t = tx(spark, [(d, a, None) for d, a in cash])
    con = duck_with({"t": ("d DATE, a DECIMAL(18,2)", cash),
                     "v": ("d DATE, v DECIMAL(38,10)", [(day(1), Decimal(7)), (None, Decimal(9))])})
    same_rows(wealth.cash_running(t), con,
              "SELECT d AS transaction_date, CAST(sum(a) OVER (ORDER BY d NULLS LAST) AS "
              "DECIMAL(38,2)) AS cash_balance FROM t")
    value = spark.createDataFrame([(day(1), Decimal(7)), (None, Decimal(9))],
                                  "as_of_date date, portfolio_value decimal(38,10)")
    out = wealth.forward_fill(wealth.cash_running(t), value)
    assert [tuple(r) for r in out.orderBy("as_of_date").collect()] == [
        (None, Decimal("3.00"), Decimal(7)), (day(0), Decimal("1.00"), None),
        (day(1), Decimal("1.00"), Decimal(7)), (day(2), Decimal("3.00"), Decimal(7))]


def test_batch_rules_report_missing_amounts_and_spans(spark):
    df = spark.createDataFrame([(day(0), "$1,234.50"), (day(40), None), (day(1), "3.5")],
                               "d date, amount string")
    rules = [quality.Rule("numeric", "amount"), quality.Rule("max_span", "d", max_value=35),
             quality.Rule("max_span", "d", max_value=40)]
    assert [r.failing_rows for r in quality.check(df, "t", rules).collect()] == [2, 1, 0]
    assert [r.failing_rows for r in quality.check(df.limit(0), "t", rules).collect()] == [0, 0, 0]


def test_quality_rules_count_one_violation_each(spark):
    df = spark.createDataFrame(
        [("a", "fidelity", "YOU BOUGHT", 1.0), ("a", "nope", "YOU SOLD", -1.0),
         (None, "vanguard", "DIVIDEND", 2.0), ("b", "vanguard", "YOU BOUGHT", None)],
        "row_hash string, source string, action string, shares_held double")
    rules = [quality.Rule("not_null", "row_hash"), quality.Rule("unique", "row_hash"),
             quality.Rule("accepted_values", "source", values=("fidelity", "vanguard")),
             quality.Rule("accepted_range", "shares_held", min_value=0),
             quality.Rule("not_null", "shares_held", where=quality.ledger_where()),
             quality.Rule("duplicates", "row_hash"), quality.Rule("non_empty")]
    out = {(r.rule, r.column_name): r.failing_rows
           for r in quality.check(df, "t", rules).collect()}
    assert all(v == 1 for k, v in out.items() if k != ("non_empty", None)), out
    assert out[("non_empty", None)] == 0


def test_span_and_sign_checks(spark):
    def span(days):
        df = spark.createDataFrame([(day(0),), (day(days),)], "d date")
        return quality.statement_span(df, "d").collect()[0].finding
    assert span(0).startswith("note") and span(35) is None and span(36).startswith("warning")
    trades = spark.createDataFrame(
        [(day(0), "A", "YOU BOUGHT", "X", 5.0, "h1"), (day(0), "A", "YOU SOLD", "X", -1.0, "h2"),
         (day(0), "A", "DIVIDEND REINVESTMENT", "X", -3.0, "h3"),
         (day(0), "A", "YOU BOUGHT", "X", -1.0, "ok")],
        "trade_date date, account string, action string, symbol string, amount double, "
        "row_hash string")
    got = sorted((r.row_hash, r.rule) for r in quality.sign_violations(trades).collect())
    assert got == [("h1", quality.BUY_RULE), ("h2", quality.SELL_RULE), ("h3", quality.SELL_RULE)]
    nulls = spark.createDataFrame([("YOU BOUGHT", None, 1.0), ("DIVIDEND", None, None)],
                                  "action string, price double, quantity double")
    assert quality.null_price_or_quantity(nulls).count() == 1
    assert quality.date_bounds(spark.createDataFrame([(day(0),), (day(9),)], "d date"),
                               "d", day(1), day(10)).count() == 1
