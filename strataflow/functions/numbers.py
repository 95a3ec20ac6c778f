"""Unit conversion, rounding and safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kmh_to_mps(kmh: Column) -> Column:
    return kmh / 3.6


def mps_to_kmh(mps: Column) -> Column:
    """Exact on decimals: the factor is a DECIMAL literal, not a double."""
    return mps * F.lit("3.6").cast("decimal(2,1)")


def celsius_to_fahrenheit(c: Column) -> Column:
    return c * 9 / 5 + 32


def narrow(value: Column, precision: int = 5, scale: int = 2) -> Column:
    """Round to a DECIMAL column, half away from zero; NULL where the value does not fit.

    The comparison keeps overflows out of the cast, which is slow at failing.
    """
    fits = F.abs(value.try_cast("double")) < 10 ** (precision - scale)
    return F.when(fits, value.try_cast(f"decimal({precision},{scale})"))


def round_numeric(value: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of the value's shortest decimal form (doubles and decimals alike)."""
    return F.round(value, digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def mean(total: Column, n: Column) -> Column:
    """Average from an exact sum and a count; NULL for an empty group."""
    return F.when(n > 0, total.cast("double") / n)
