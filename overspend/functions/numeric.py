"""Rounding and money helpers as native Column expressions.

Two rounding semantics appear in the rules and reports:

* ``array_round`` — round ``x * 10**d`` half-to-even as a double, then divide
  (what column-wise array rounding does).  Used for per-row leakage and for
  rounded group totals.
* ``exact_round`` — round the exact binary value of ``x`` half-to-even, i.e.
  the decimal with ``d`` places nearest to ``x`` (what scalar float rounding
  does).  Used for the financial score.  Spark's ``bround`` rounds the
  shortest decimal *string* of a double instead (``bround(2.675, 2) = 2.68``
  although 2.675 is stored as 2.67499…), so it cannot be used here.  The exact
  form needs the rounding error of ``x * 10**d``, obtained with Dekker's
  error-free product in plain double arithmetic (no UDF; stays in codegen).

Money totals are exact decimal sums, so they do not depend on partitioning
or task order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, Dekker/Veltkamp split constant


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_round(c: Column | str, digits: int) -> Column:
    """Half-even rounding of ``x * 10**digits`` in double arithmetic."""
    scale = float(10**digits)
    x = _col(c)
    if digits == 0:
        return F.rint(x)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def exact_round(c: Column | str, digits: int) -> Column:
    """Correctly rounded half-even rounding of the exact binary value."""
    scale = float(10**digits)
    x = _col(c)
    s = F.lit(scale)
    p = x * s
    hi_part = F.lit(_SPLIT) * x
    x_hi = hi_part - (hi_part - x)
    x_lo = x - x_hi
    # exact x*scale == p + err (scale has few significant bits, so it needs no split)
    err = (x_hi * s - p) + x_lo * s
    r = F.rint(p)
    tie = F.abs(p - r) == F.lit(0.5)
    rounded = (
        F.when(tie & (err > 0), p + F.lit(0.5))
        .when(tie & (err < 0), p - F.lit(0.5))
        .otherwise(r)
    )
    return rounded / s


def nan_to_null(c: Column | str) -> Column:
    """A number that is none, or that is infinite, becomes null: no amount, and no total, can hold it."""
    x = _col(c)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


# Exact totals: each double enters the sum as decimal(38,18) (its shortest
# decimal form, exact for money values), the total is rounded half-even to
# cents.  The result does not depend on partitioning or summation order.
SUM_TYPE = "decimal(38,18)"
MONEY = "decimal(38,2)"


def money_total(c: Column | str) -> Column:
    """Exact total of a money column rounded to cents, as ``decimal(38,2)``; 0.00 of nothing or of nulls."""
    return F.coalesce(F.bround(F.sum(_col(c).cast(SUM_TYPE)), 2).cast(MONEY), F.lit(0).cast(MONEY))


def exact_sum(c: Column | str) -> Column:
    """Exact (unrounded) total as ``decimal(38,18)``."""
    return F.sum(_col(c).cast(SUM_TYPE))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with ``+inf`` / ``-inf`` / null for a zero denominator.

    Matches float division semantics (x/0 = ±inf, 0/0 = NaN → null) without
    tripping ANSI divide-by-zero errors.
    """
    n, d = _col(num), _col(den)
    return (
        F.when(d != 0, n / d)
        .when((d == 0) & (n > 0), F.lit(float("inf")))
        .when((d == 0) & (n < 0), F.lit(float("-inf")))
    )
