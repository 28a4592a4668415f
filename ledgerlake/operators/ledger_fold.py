"""Average-cost running ledger (G11) as a sorted, streaming fold.

Per (symbol, source), trades are processed in (trade_date, amount, row_hash)
order and carry three state values: shares held, cost basis and the realized
gain of the row.  Every step is rounded to decimal(18,6) / decimal(18,2) and the
rounding feeds into the next step, so the recurrence is not associative and
cannot be a prefix scan; it is a sequential fold per key, parallel across keys.

Plan (one for every size): filter -> drop all but the first row of a NULL key in each
task -> hash exchange on (symbol, source) -> sort within partition -> ``mapInArrow``
streaming over the sorted rows with O(1) state.  A key never has to fit in memory: the
sort spills, the fold reads Arrow batches in order and carries state across batch
boundaries.  Keys run in parallel; one ledger is sequential by definition, because the
rounded value of a step is the input of the next.

Arithmetic contract (the model's SQL semantics, reproduced exactly with integer
units: shares in 1e-6, prices in 1e-4, money in cents):
  first row of a key: shares = qty and cost = round(qty * price, 2) if a buy,
      else 0 / 0; realized = 0.
  later rows: the CASE expressions mix decimal and double branches, so they are
      evaluated in double and cast back to decimal by round_half_away(x * 10^s):
      buy  -> S + q,  double(C + q * p)
      sell -> S - q,  C - q * (C / nullif(S, 0))
      realized (text contains 'sold') = amount - q * (C / nullif(S, 0)), else 0.
  'bought'/'reinvestment' wins over 'sold' for shares and cost.
  A NULL symbol or source never matches the recursive join, so only the first
  row of such a key is emitted.
Decimal -> double conversion is correctly rounded, as in the reference engine.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.hashing import packed, unpacked
from ledgerlake.functions.text import is_buy, is_ledger_action, is_sell
from ledgerlake.session import ship_package

_TWO53 = 2 ** 53

LOT_COLUMNS = ["rn", "trade_date", "symbol", "source", "account", "action", "quantity", "price",
               "amount", "shares_held", "cost_basis", "realized_gain"]
ORDER_COLUMNS = ["trade_date", "amount", "row_hash"]


def _to_double(units: int, scale: int) -> float:
    """Correctly rounded double of the decimal units * 10^-scale."""
    if -_TWO53 < units < _TWO53:
        return units / float(10 ** scale)
    return float(Fraction(units, 10 ** scale))


def _round_away(y: float) -> int:
    """round half away from zero of a double, to an integer (exact for |y| < 2^52)."""
    if y != y or y in (math.inf, -math.inf):
        raise ArithmeticError("non-finite value in ledger arithmetic")
    if y < 0:
        return -_round_away(-y)
    r = math.floor(y)
    return int(r) + (1 if y - r >= 0.5 else 0)


def _div_round_away(n: int, d: int) -> int:
    """round half away from zero of the exact rational n / d (d > 0)."""
    q, r = divmod(abs(n), d)
    if 2 * r >= d:
        q += 1
    return q if n >= 0 else -q


def _to_cents(x: float) -> int:
    return _round_away(x * 100.0)


def _step(first, buy, sell, sold, q, p, a, S, C):
    """One ledger row given the state (S, C) before it; returns (S', C', realized)."""
    if first:
        if buy:
            return q, (None if (q is None or p is None) else _div_round_away(q * p, 10 ** 8)), 0
        return 0, 0, 0
    avg = None
    if (sell or sold) and C is not None and S is not None and S != 0:
        avg = _to_double(C, 2) / _to_double(S, 6)
    if buy:
        nS = None if (S is None or q is None) else S + q
        nC = None if (C is None or q is None or p is None) else \
            _to_cents(_to_double(C * 10 ** 8 + q * p, 10))
    elif sell:
        nS = None if (S is None or q is None) else S - q
        nC = None if (avg is None or q is None) else _to_cents(_to_double(C, 2) - _to_double(q, 6) * avg)
    else:
        nS, nC = S, C
    if sold:
        R = None if (avg is None or q is None or a is None) else \
            _to_cents(_to_double(a, 2) - _to_double(q, 6) * avg)
    else:
        R = 0
    return nS, nC, R


def fold_rows(keys, buys, sells, solds, qs, ps, amts, state):
    """Fold one batch of rows that arrive sorted by key and ledger order.

    ``state`` is a dict carrying (key, rn, S, C) across batches.  Returns lists
    rn, shares units, cost cents, realized cents and a keep mask.
    """
    n = len(keys)
    out_rn = [0] * n
    out_s = [None] * n
    out_c = [None] * n
    out_r = [None] * n
    keep = [True] * n
    key, rn, S, C = state["key"], state["rn"], state["S"], state["C"]
    for i in range(n):
        k = keys[i]
        if k != key or rn == 0:
            key, rn = k, 0
        rn += 1
        out_rn[i] = rn
        if rn > 1 and (k[0] is None or k[1] is None):
            keep[i] = False
            continue
        S, C, R = _step(rn == 1, bool(buys[i]), bool(sells[i]), bool(solds[i]),
                        qs[i], ps[i], amts[i], S, C)
        out_s[i], out_c[i], out_r[i] = S, C, R
    state.update(key=key, rn=rn, S=S, C=C)
    return out_rn, out_s, out_c, out_r, keep


_PASS = LEDGER_COLUMNS = ["trade_date", "symbol", "source", "account", "action", "quantity",
                          "price", "amount"]


def _fold_partition(batches):
    state = {"key": None, "rn": 0, "S": None, "C": None}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keys = list(zip(col["symbol"].to_pylist(), col["source"].to_pylist()))
        rn, s, c, r, keep = fold_rows(
            keys, col["_buy"].to_pylist(), col["_sell"].to_pylist(), col["_sold"].to_pylist(),
            col["_q"].to_pylist(), col["_p"].to_pylist(), col["_a"].to_pylist(), state)
        out = pa.RecordBatch.from_arrays(
            [pa.array(rn, pa.int64())] + [col[c_] for c_ in _PASS]
            + [pa.array(s, pa.int64()), pa.array(c, pa.int64()), pa.array(r, pa.int64())],
            names=["rn"] + _PASS + ["_s", "_c", "_r"])
        if not all(keep):
            out = out.filter(pa.array(keep, pa.bool_()))
        yield out


def _first_of_null_keys(batches, keys=("symbol", "source")):
    """Pass rows with a full key on; of a key with a NULL, keep this task's first row only.

    Only the first row of such a key is ever emitted, so a NULL key that holds most of the
    rows must not be shuffled to one task.  ``keys``: those whose NULL counts.
    """
    first: dict[tuple, tuple] = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        null = reduce(pc.or_, [pc.is_null(batch[k]) for k in keys])
        if pc.any(null).as_py():
            for row in batch.filter(null).to_pylist():
                order = tuple(x for c in ORDER_COLUMNS for x in (row[c] is None, row[c] or 0))
                key = row["symbol"], row["source"]
                if key not in first or order < first[key][0]:
                    first[key] = order, row
            batch = batch.filter(pc.invert(null))
        yield batch
    if first:
        yield pa.RecordBatch.from_pylist([r for _, r in first.values()], schema=schema)


def _units(col: str, scale: int):
    return (F.col(col) * F.lit(10 ** scale)).cast("long")


def _from_units(col: str, precision: int, scale: int):
    step = Decimal(1).scaleb(-scale)
    return (F.col(col).cast("decimal(20,0)") * F.lit(step)).cast(f"decimal({precision},{scale})")


def _ledger_trades(stg_trades: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    return stg_trades.filter(is_ledger_action("action")).select(*_PASS, "row_hash", *more)


def _with_units(trades: DataFrame) -> DataFrame:
    """What the fold reads of a trade: the kind of action and integer units."""
    return trades.select("*", is_buy("action").alias("_buy"),
                         (~is_buy("action") & is_sell("action")).alias("_sell"),
                         is_sell("action").alias("_sold"),
                         _units("quantity", 6).alias("_q"), _units("price", 4).alias("_p"),
                         _units("amount", 2).alias("_a"))


def _ledger_rows(stg_trades: DataFrame) -> DataFrame:
    return _with_units(_ledger_trades(stg_trades))


def position_lots(stg_trades: DataFrame, num_partitions: int | None = None,
                  made_of: tuple[Sequence[str], Column] | None = None) -> DataFrame:
    """Running shares, average cost basis and realized gain per trade.

    ``num_partitions``: of the exchange, whose tasks are not merged then.  ``made_of``: further
    columns that the hash can be made of again, and how; they are shipped then, and the hash
    is not.
    """
    ship_package(stg_trades.sparkSession)
    more, back = made_of or ((), unpacked("row_hash"))
    rows = _ledger_trades(stg_trades, more)
    rows = rows.mapInArrow(_first_of_null_keys, rows.schema)
    parts = [num_partitions] if num_partitions else []
    # The exchange ships a trade's columns and its hash as bytes; units are made behind it.
    shipped = more if made_of else packed("row_hash")
    ordered = _with_units(
        rows.select(*_PASS, *shipped).repartition(*parts, "symbol", "source")
        .select(*_PASS, back.alias("row_hash"))
        .sortWithinPartitions(*[F.col(c).asc_nulls_last()
                                for c in ("symbol", "source", *ORDER_COLUMNS)])
        .select(*_PASS))
    types = dict(ordered.dtypes)
    folded = ordered.mapInArrow(_fold_partition, ", ".join(
        ["rn bigint", *[f"{c} {types[c]}" for c in _PASS], "_s bigint", "_c bigint", "_r bigint"]))
    return _finish(folded)


def position_lots_in_place(stg_trades: DataFrame) -> DataFrame:
    """The same over a table that is laid out by (symbol, source): no exchange.

    A window over the keys asks for rows of a key together, in ledger order; a table bucketed
    by them gives that as it is (any other input is exchanged, as ``position_lots`` does).
    The fold then reads the window's rows, which stay in that order.
    """
    ship_package(stg_trades.sparkSession)
    order = [F.col(c).asc_nulls_last() for c in ORDER_COLUMNS]
    # The place in the ledger; of a NULL key only the first row counts.
    place = F.row_number().over(Window.partitionBy("symbol", "source").orderBy(*order))
    rows = _ledger_rows(stg_trades).withColumn("_rn", place).filter(
        (F.col("symbol").isNotNull() & F.col("source").isNotNull()) | (F.col("_rn") == 1))
    types = dict(rows.dtypes)
    return _finish(rows.mapInArrow(_fold_partition, ", ".join(
        ["rn bigint", *[f"{c} {types[c]}" for c in _PASS], "_s bigint", "_c bigint", "_r bigint"])))


def _finish(folded: DataFrame) -> DataFrame:
    return folded.select(
        "rn", "trade_date", "symbol", "source", "account", "action", "quantity", "price", "amount",
        _from_units("_s", 18, 6).alias("shares_held"),
        _from_units("_c", 18, 2).alias("cost_basis"),
        _from_units("_r", 18, 2).alias("realized_gain"))
