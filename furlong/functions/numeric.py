"""Rounding, division, hashing and date literals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(value: Column, digits: int) -> Column:
    """Round half to even, scaling by a power of ten."""
    return F.rint(value * F.lit(10.0 ** digits)) / F.lit(10.0 ** digits)


def rnd_mean(value: Column, digits: int) -> Column:
    """``rnd`` for sums and means of doubles.

    Their last bits depend on the order in which partitions arrive; snapping to nine decimals first
    keeps a tie a tie, so that a retried task gives the same rounded value.
    """
    return rnd(rnd(value, 9), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def square(value: Column) -> Column:
    return value * value


def keyed_hash(key: str, seed: int | str) -> Column:
    """32 hex digits that depend on the key and the seed only; their text order is a random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def digamma(n: Column) -> Column:
    """The digamma function at numbers from 1 on: its series at ``n + 6``, taken back by six steps."""
    x = n.cast("double") + 6
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6) + 1 / (240 * x ** 8)
    for i in range(6):
        series = series - 1 / (n + i)
    return series


def finite_or_null(value: Column) -> Column:
    """Infinite and NaN values become null."""
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit(None)).otherwise(value)


def clipped(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; null stays null (``greatest`` and ``least`` alone would drop it)."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def moment(at: datetime) -> Column:
    """A timestamp literal without time zone, the same whatever the zones of the driver and the session are."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
