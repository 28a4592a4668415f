"""Numeric column helpers with the money semantics the models are defined in.

The models were specified on an engine whose arithmetic differs from Spark's in
a few places; these helpers pin the behaviour down explicitly:

* decimal / decimal yields DOUBLE (Spark would give a wide decimal),
* round(double, n) scales in binary: round_half_away(x * 10^n) / 10^n,
* cast(double -> decimal(p, s)) also scales in binary, then rounds half away
  from zero (Spark's cast rounds the shortest decimal text instead),
* division guards use NULLIF so x / 0 is NULL, never an error.

All are plain Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


_TWO52 = float(2 ** 52)


def round_half_away(y) -> Column:
    """Round a double half away from zero to an integral double, in plain arithmetic.

    For |y| < 2^52, y - floor(y) is exact, so the half test has no rounding
    error; larger doubles are integral already.  No BigDecimal on the way.
    """
    y = _c(y)
    a = F.abs(y)
    fl = F.floor(a).cast("double")
    r = F.when(a - fl >= F.lit(0.5), fl + F.lit(1.0)).otherwise(fl)
    return F.when(a >= F.lit(_TWO52), y).otherwise(F.when(y < 0, -r).otherwise(r))


def round_dbl(x, n: int) -> Column:
    """round(double, n) as round_half_away(x * 10^n) / 10^n, in binary."""
    m = float(10 ** n)
    x = _c(x).cast("double")
    r = round_half_away(x * F.lit(m)) / F.lit(m)
    # A result of zero keeps the sign of the input (-0.4 rounds to -0.0).
    return F.when(r == 0.0, x * F.lit(0.0)).otherwise(r)


def dbl_to_dec(x, precision: int, scale: int) -> Column:
    """cast(double AS decimal(precision, scale)) scaling in binary.

    The double is scaled by 10^scale in binary first; casting that to an
    integral decimal rounds its shortest text half away from zero, which for an
    integral target equals rounding the binary value (the text can only end in
    exactly .5 when the double is exactly .5).  Compact generated code: one
    multiply and one cast per value.
    """
    step = Decimal(1).scaleb(-scale)
    units = (_c(x).cast("double") * F.lit(float(10 ** scale))).cast(f"decimal({precision},0)")
    return (units * F.lit(step)).cast(f"decimal({precision},{scale})")


def to_dbl(x) -> Column:
    return _c(x).cast("double")


def safe_div(a, b) -> Column:
    """a / NULLIF(b, 0) computed in DOUBLE (decimal / decimal -> double)."""
    b = _c(b)
    return to_dbl(a) / F.nullif(to_dbl(b), F.lit(0.0))


def pct(a, b, n: int) -> Column:
    """round(a / nullif(b, 0) * 100, n) with binary rounding."""
    return round_dbl(safe_div(a, b) * F.lit(100.0), n)
