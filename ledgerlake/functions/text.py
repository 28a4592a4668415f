"""String predicates and labels used across the ledger models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action keywords that classify a broker ledger row
# (case-insensitive substring match).
BOUGHT = "bought"
SOLD = "sold"
REINVESTMENT = "reinvestment"
DIVIDEND = "dividend"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_word(col, word: str) -> Column:
    """col ILIKE '%word%' (NULL-safe: NULL stays NULL, so when() treats it as false)."""
    return _c(col).ilike(f"%{word}%")


def is_buy(action="action") -> Column:
    """Bought or reinvestment: both add shares at cost."""
    return has_word(action, BOUGHT) | has_word(action, REINVESTMENT)


def is_sell(action="action") -> Column:
    return has_word(action, SOLD)


def is_ledger_action(action="action") -> Column:
    """Rows that move a position: bought, sold or reinvestment."""
    return is_buy(action) | is_sell(action)


def signed_quantity(action="action", quantity="quantity") -> Column:
    """+quantity for buys/reinvestments, -quantity for sells, else 0 (buy wins)."""
    q = _c(quantity)
    return F.when(is_buy(action), q).when(is_sell(action), -q).otherwise(F.lit(0))


def account_label(file_name) -> Column:
    """Filename stem (last extension removed) up to the first underscore.

    'a.b_c.csv' -> 'a.b'; 'plain.csv' -> 'plain'.
    """
    stem = F.regexp_replace(_c(file_name), r"\.[^.]*$", "")
    return F.split(stem, "_").getItem(0)


def base_name(path) -> Column:
    """Last path component of a file path or URI."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)
