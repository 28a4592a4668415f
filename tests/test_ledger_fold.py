"""Average-cost ledger (G11): edge rows and random ledgers against the recursive SQL form."""
import datetime as dt
import random
from decimal import Decimal

import pytest

from ledgerlake.operators import ledger_fold
from ledgerlake.operators.ledger_fold import fold_rows, position_lots
from ledgerlake.plans.duckdb_oracle import sql
from tests.helpers import TRADE_DDL, TRADE_SPARK, D, duck_with, same

LOTS_SQL = sql("SELECT * FROM position_lots", given={"stg_trades"})


def trade(day, action, qty, price, amount, symbol="AAA", source="fidelity", h=None):
    return (dt.date(2026, 1, 1) + dt.timedelta(days=day), "ACCT-1", action, symbol, "USD",
            D(price), D(qty), D(amount), "acct", source, h or f"{symbol}-{source}-{day}-{amount}")


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, TRADE_SPARK)
    out = position_lots(df, **kw)
    con = duck_with({"stg_trades": (TRADE_DDL, rows)})
    same(out, con, LOTS_SQL)
    return {(r.symbol, r.source, r.rn): r for r in out.collect()}


def test_buy_buy_sell_average_cost(spark):
    r = check(spark, [trade(0, "YOU BOUGHT", 10, 10, -100), trade(1, "YOU BOUGHT", 10, 20, -200),
                      trade(2, "YOU SOLD", 5, 30, 150)])
    last = r[("AAA", "fidelity", 3)]
    assert last.shares_held == Decimal("15.000000")
    assert last.cost_basis == Decimal("225.00")
    assert last.realized_gain == Decimal("75.00")


def test_first_row_sell_is_ignored(spark):
    r = check(spark, [trade(0, "YOU SOLD", 5, 10, 50), trade(1, "YOU BOUGHT", 2, 10, -20)])
    first = r[("AAA", "fidelity", 1)]
    assert (first.shares_held, first.cost_basis, first.realized_gain) == (0, 0, 0)


def test_sell_to_zero_then_sell_makes_cost_null(spark):
    r = check(spark, [trade(0, "YOU BOUGHT", 5, 10, -50), trade(1, "YOU SOLD", 5, 12, 60),
                      trade(2, "YOU SOLD", 1, 12, 12), trade(3, "YOU BOUGHT", 1, 12, -12)])
    assert r[("AAA", "fidelity", 2)].cost_basis == 0
    assert r[("AAA", "fidelity", 3)].cost_basis is None
    assert r[("AAA", "fidelity", 4)].cost_basis is None


def test_sell_to_zero_then_buy_restarts_cost(spark):
    r = check(spark, [trade(0, "YOU BOUGHT", 3, 10, -30), trade(1, "YOU SOLD", 3, 11, 33),
                      trade(2, "YOU BOUGHT", 2, 7, -14)])
    assert r[("AAA", "fidelity", 3)].cost_basis == Decimal("14.00")


def test_half_cent_rounds_in_binary(spark):
    # 1.00 + 1 x 0.005 is exactly 1.005, whose double is below the half: 1.00.
    r = check(spark, [trade(0, "YOU BOUGHT", 1, 1, -1), trade(1, "YOU BOUGHT", 1, "0.005", -1)])
    assert r[("AAA", "fidelity", 2)].cost_basis == Decimal("1.00")


def test_same_day_buy_sorts_before_sell_and_dividend_ignored(spark):
    r = check(spark, [trade(0, "YOU SOLD", 1, 10, 10), trade(0, "YOU BOUGHT", 4, 10, -40),
                      trade(0, "DIVIDEND RECEIVED", None, None, 3)])
    assert r[("AAA", "fidelity", 1)].action == "YOU BOUGHT"
    assert len(r) == 2


def test_null_symbol_keeps_only_first_row(spark):
    r = check(spark, [trade(0, "YOU BOUGHT", 1, 10, -10, symbol=None),
                      trade(1, "YOU BOUGHT", 1, 10, -10, symbol=None)])
    assert list(r) == [(None, "fidelity", 1)]


def test_two_brokers_are_independent_and_long_groups_complete(spark):
    rows = [trade(i, "YOU BOUGHT" if i % 3 else "YOU SOLD", 2 + i % 5, 10 + i % 7,
                  (-1 if i % 3 else 1) * (20 + i), source=src)
            for i in range(150) for src in ("fidelity", "vanguard")]
    r = check(spark, rows)
    assert len(r) == 300
    assert max(k[2] for k in r) == 150


def test_reinvestment_and_sold_text_is_a_buy_with_realized(spark):
    check(spark, [trade(0, "YOU BOUGHT", 4, 10, -40),
                  trade(1, "REINVESTMENT OF SOLD SHARES", 1, 10, -10)])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_ledgers_match_recursive_sql(spark, seed):
    rnd = random.Random(seed)
    actions = ["YOU BOUGHT", "YOU SOLD", "REINVESTMENT", "YOU SOLD", "Dividend Reinvestment"]
    rows = []
    for g in range(40):
        sym, src = f"S{g % 13}", ("fidelity", "vanguard")[g % 2]
        for i in range(rnd.randint(1, 25)):
            q = Decimal(rnd.randint(1, 400000)) / Decimal(1000)
            p = Decimal(rnd.randint(1, 9999999)) / Decimal(10000)
            if rnd.random() < 0.05:
                p = None
            a = Decimal(rnd.randint(-500000, 500000)) / Decimal(100)
            act = rnd.choice(actions)
            rows.append(trade(rnd.randint(0, 60), act, q, p, a, symbol=sym, source=src,
                              h=f"{g}-{i}"))
    check(spark, rows)


def test_fold_state_crosses_batches():
    keys = [("A", "f")] * 4
    state = {"key": None, "rn": 0, "S": None, "C": None}
    one = fold_rows(keys[:2], [True, True], [False, False], [False, False],
                    [1_000_000, 1_000_000], [10_0000, 20_0000], [-1000, -2000], state)
    two = fold_rows(keys[2:], [False, True], [True, False], [True, False],
                    [1_000_000, 1_000_000], [30_0000, 30_0000], [3000, -3000], state)
    assert one[0] == [1, 2] and two[0] == [3, 4]
    assert two[2][0] == 1500  # cost 30.00 - 1 x 15.00


def test_reset_to_zero_and_null_costs(spark):
    rows, i = [], 0
    for rep in range(6):                       # buy-buy-sell to zero, repeated
        rows += [trade(i, "YOU BOUGHT", 3, 10 + rep, -30), trade(i + 1, "YOU BOUGHT", 1, "0.005", -1),
                 trade(i + 2, "YOU SOLD", 4, 12, 48)]
        i += 3
    rows += [trade(i, "YOU SOLD", 1, 12, 12),   # sell at zero shares: cost NULL from here on
             trade(i + 1, "YOU BOUGHT", 2, 5, -10), trade(i + 2, "YOU SOLD", 2, 6, 12),
             trade(i + 3, "YOU BOUGHT", 2, 5, -10)]
    rows += [trade(0, "YOU SOLD", 1, 3, 3, symbol="BBB"),   # first-row sell
             trade(1, "YOU BOUGHT", 2, None, -7, symbol="BBB"),  # NULL price poisons cost
             trade(2, "YOU SOLD", 2, 4, 8, symbol="BBB"), trade(3, "YOU BOUGHT", 1, 4, -4, symbol="BBB")]
    r = check(spark, rows)
    assert r[("AAA", "fidelity", 3)].cost_basis == 0
    assert r[("AAA", "fidelity", 19)].cost_basis is None


@pytest.mark.parametrize("seed", [11, 12])
def test_random_ledgers_with_closed_positions(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for g in range(4):
        sym, src = f"H{g}", ("fidelity", "vanguard")[g % 2]
        held = Decimal(0)
        for i in range(rnd.randint(20, 120)):
            q = Decimal(rnd.randint(1, 40)) / 4
            act = rnd.choice(["YOU BOUGHT", "YOU SOLD", "REINVESTMENT"])
            if act == "YOU SOLD" and held > 0 and rnd.random() < 0.4:
                q = held                                  # close the position exactly
            held = held + q if act != "YOU SOLD" else held - q
            p = None if rnd.random() < 0.02 else Decimal(rnd.randint(1, 999999)) / 10000
            a = Decimal(rnd.randint(-90000, 90000)) / 100
            rows.append(trade(i, act, q, p, a, symbol=sym, source=src, h=f"{g}-{i}"))
    check(spark, rows)


def test_hot_and_null_keys_in_many_tasks(spark):
    rows = [trade(i % 90, "YOU BOUGHT" if i % 3 else "YOU SOLD", 1 + i % 4, 10, -i, symbol="HOT",
                  h=f"{i:05d}") for i in range(1500)]
    rows += [trade(i % 90, "YOU BOUGHT", 1, 10, -i, symbol=None, h=f"n{i:05d}") for i in range(1500)]
    rows += [trade(i % 90, "YOU SOLD", 1, 10, i, source=None, h=f"s{i:05d}") for i in range(300)]
    r = check(spark, rows, num_partitions=7)
    assert sum(k[0] is None for k in r) == 1 and sum(k[1] is None for k in r) == 1
    reduced = ledger_fold._first_of_null_keys
    df = spark.createDataFrame(rows, TRADE_SPARK).repartition(4)
    lines = ledger_fold._ledger_rows(df)
    assert lines.mapInArrow(reduced, lines.schema).filter("symbol IS NULL").count() <= 4
