"""Rounding and bounded arithmetic with explicit null and NaN behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero after removing floating-point noise.

    An average of doubles depends in its last bits on the order of addition,
    which a cluster does not fix. Cutting those off at twelve digits first makes
    a tie fall the same way on every run; values of any size pass, infinities
    and NaN unchanged.
    """
    return F.round(F.round(value, 12), digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value of a double column, ties to the even digit.

    ``round`` and ``bround`` look at the shortest decimal text of a double, so
    1.005 (stored just below 1.005) rounds up. Here the error of the scaling
    product is recovered exactly (splitting the factor in two halves, Dekker
    1971) and only a product that is exactly half-way counts as a tie. Pass a
    plain column: the value is used many times.
    """
    scale = float(10**digits)
    product = value * F.lit(scale)
    nearest = F.rint(product)
    half_way = F.abs(product - nearest) == 0.5
    high = _upper_half(value)
    error = (high * F.lit(scale) - product) + (value - high) * F.lit(scale)
    rounded = (
        F.when(half_way & (error > 0), product + 0.5)
        .when(half_way & (error < 0), product - 0.5)
        .otherwise(nearest)
    )
    # From 2^52 on the product has no fraction left to decide on.
    return F.when(F.abs(product) < F.lit(float(2**52)), rounded / F.lit(scale)).otherwise(value)


def _upper_half(value: Column) -> Column:
    """The top 26 bits of a double's significand."""
    shifted = value * F.lit(134217729.0)
    return shifted - (shifted - value)


def clamp_percent(value: Column) -> Column:
    """Clamp to [0, 100]; a missing value is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(value, F.lit(0.0))))


def cap_at_100(value: Column) -> Column:
    """Upper bound of 100 that keeps null (``least`` alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.lit(100.0), value))


def json_number(text: Column) -> Column:
    """Number from a JSON value held as text, null if it is none.

    Bare ``NaN`` and infinities arrive wrapped in quotes. Java's number grammar
    also takes a type suffix (12.5d), which is made unreadable here.
    """
    plain = F.translate(text, 'dDfF"', "xxxx")
    infinity = F.when(F.lower(text).contains("inf"), F.btrim(text, F.lit('"')))
    return F.coalesce(plain.try_cast("double"), infinity.try_cast("double"))
