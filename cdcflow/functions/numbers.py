"""Exact rounding of ratios, amounts as text, and repeatable amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``round(numerator / denominator, digits)`` of whole numbers, exact, halves away from zero.

    Integer arithmetic on DECIMAL(38,0): no double, no quotient rounded twice. NULL for a zero or NULL
    denominator.
    """
    whole = "decimal(38,0)"
    num = (numerator.cast(whole) * F.lit(10**digits).cast(whole)).cast(whole)
    den = F.abs(denominator.cast(whole))
    doubled = (F.abs(num) * 2 + den).cast(whole)
    step = (den * 2).cast(whole)
    steps = ((doubled - doubled % step) / step).cast(whole)
    sign = F.when((num < 0) != (denominator < 0), F.lit(-1)).otherwise(F.lit(1))
    value = (steps * sign).cast(f"decimal({20 + digits},0)")
    # The division by a power of ten is exact at this scale.
    scaled = (value / F.lit(10**digits)).cast(f"decimal(20,{digits})") if digits else value
    return F.when(denominator != 0, scaled)


def amount_text(amount: Column, precision: int = 15, scale: int = 2) -> Column:
    """An amount as decimal text with a fixed number of places."""
    return amount.cast(f"decimal({precision},{scale})").cast("string")


def keyed_amount(key: Column, low: int, high: int, salt: int = 0) -> Column:
    """A pseudo-random amount of whole cents in ``[low, high]``, the same on every run for one whole-number key.

    Two steps of a multiplicative generator modulo a prime; any engine can repeat them.
    """
    prime = 2_147_483_647
    step = F.pmod(F.pmod(key.cast("bigint") + salt, F.lit(prime)) * 48_271 + 11, F.lit(prime))
    cents = F.pmod(step * 69_621 + 7, F.lit(prime)) % ((high - low) * 100 + 1) + low * 100
    return (cents.cast("decimal(17,0)") / F.lit(100)).cast("decimal(17,2)")


def random_amount(low: float, high: float, seed: int | None = None) -> Column:
    """A random amount in ``[low, high)``, rounded to cents."""
    return F.round(F.lit(low) + F.rand(seed) * F.lit(high - low), 2)
