"""Column helpers for money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = 1_000_000


def rnd(value: Column, digits: int) -> Column:
    """Half-up decimal rounding that hides last-bit noise of double arithmetic.

    The value is first fixed at 10 decimals, so sums taken in another order still round alike.
    NaN and values too large for the decimal become NULL.  (Rounding by double arithmetic is faster
    on its own, but a projection with many of them grows past what the JVM compiles.)
    """
    return F.round(value.try_cast("decimal(38,10)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL, not an error or infinity, for a zero denominator."""
    return F.try_divide(numerator, denominator)


def finite_or_null(value: Column) -> Column:
    """NaN and infinities as NULL, for tables whose readers know only NULL."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on row order (kept to a millionth per row).

    Whole part and millionths are summed as longs: order-independent like a decimal sum, but with
    fixed-width buffers, so the hash aggregate stays as fast as for plain doubles.
    """
    whole = F.floor(value)
    micros = F.rint((value - whole) * F.lit(float(_MICROS))).cast("long")
    return F.sum(whole) + F.sum(micros) / F.lit(float(_MICROS))
