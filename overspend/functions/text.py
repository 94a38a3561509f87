"""Text formatting of numbers and dates as native Column expressions.

``format_number`` rounds half-even on the exact binary value, the same as
fixed-point string formatting of floats; it inserts thousands separators,
which are removed where the output has none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _special(x: Column, formatted: Column) -> Column:
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(x == F.lit(float("inf")), F.lit("inf"))
        .when(x == F.lit(float("-inf")), F.lit("-inf"))
        .otherwise(formatted)
    )


def grouped(c: Column | str, digits: int) -> Column:
    """Fixed-point with thousands separators: 1234.5 -> '1,234.50'."""
    x = _col(c).cast("double")
    return _special(x, F.format_number(x, digits))


def fixed(c: Column | str, digits: int) -> Column:
    """Fixed-point without separators: 1234.56 -> '1234.6' (digits=1)."""
    x = _col(c).cast("double")
    return _special(x, F.regexp_replace(F.format_number(x, digits), ",", ""))


def iso_date(c: Column | str) -> Column:
    """yyyy-MM-dd: what a date is as a string (years 0000 to 9999)."""
    return _col(c).cast("date").cast("string")


def fmt_param(value: float, digits: int) -> str:
    """Driver-side formatting of a scalar parameter (same rounding rule)."""
    return f"{value:.{digits}f}"
