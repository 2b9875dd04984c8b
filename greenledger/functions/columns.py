"""Column expressions shared by the operators. All are JVM-side built-ins."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tolerances of the feasibility and balance checks.
CHECK_TOLERANCE = 1e-6
CEIL_TOLERANCE = 1e-9


def week_index(date: Column | str, anchor: str) -> Column:
    """1-based week counted from the anchor day; days before it fall in week 0, -1, .."""
    days = F.datediff(F.to_date(date), F.to_date(F.lit(anchor)))
    return (F.floor(days / F.lit(7.0)) + 1).cast("int")


def effective_yield() -> Column:
    """Sellable pounds per tray, from the parameter columns."""
    return F.col("yield_lbs_per_tray") * (F.lit(1.0) - F.col("shrink"))


def trays_needed(demand: Column, per_tray: Column) -> Column:
    """Least whole number of trays that covers the demand (null without a yield)."""
    ratio = F.when(per_tray > 0, demand / per_tray)
    return F.ceil(ratio - F.lit(CEIL_TOLERANCE)).cast("long")


def clamp(value: Column, low: Column | float, high: Column | float | None = None) -> Column:
    """Bound a value below and, when given, above."""
    low = low if isinstance(low, Column) else F.lit(low)
    if high is not None:
        value = F.least(value, high if isinstance(high, Column) else F.lit(high))
    return F.greatest(value, low)


def seasonal(week: Column, weeks: int, amplitude: Column | float, base: float = 1.0) -> Column:
    """One sine period over the horizon around ``base``."""
    amplitude = amplitude if isinstance(amplitude, Column) else F.lit(amplitude)
    angle = F.lit(2.0 * math.pi) * week / F.lit(float(max(weeks, 1)))
    return F.lit(base) + amplitude * F.sin(angle)


def _digest(seed: int, tag: str, keys: tuple[Column, ...]) -> Column:
    return F.md5(
        F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *(k.cast("string") for k in keys)).cast(
            "binary"
        )
    )


def _word(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("double")


def noise_uniform(
    seed: int, tag: str, *keys: Column, low: float = 0.0, high: float = 1.0
) -> Column:
    """Uniform in [low, high), a pure function of the seed, a tag and the row's keys,
    so every row is drawn on its own executor and a lost task redraws the same."""
    unit = _word(_digest(seed, tag, keys), 1) / F.lit(4294967296.0)
    return F.lit(low) + unit * F.lit(high - low)


def noise_normal(
    seed: int, tag: str, *keys: Column, mean: float = 0.0, std: Column | float = 1.0
) -> Column:
    """Normal draw by Box-Muller from two words of one digest."""
    digest = _digest(seed, tag, keys)
    u1 = (_word(digest, 1) + F.lit(1.0)) / F.lit(4294967296.0)
    u2 = _word(digest, 9) / F.lit(4294967296.0)
    std = std if isinstance(std, Column) else F.lit(std)
    return F.lit(mean) + std * F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def noise_exponential(seed: int, tag: str, *keys: Column) -> Column:
    """Exponential draw with mean 1, strictly positive."""
    return -F.ln((_word(_digest(seed, tag, keys), 1) + F.lit(1.0)) / F.lit(4294967297.0))


def noise_int(seed: int, tag: str, *keys: Column, low: int, high: Column | int) -> Column:
    """Integer in [low, high)."""
    high = high if isinstance(high, Column) else F.lit(high)
    span = (high - F.lit(low)).cast("double")
    return (F.lit(low) + F.floor(noise_uniform(seed, tag, *keys) * span)).cast("int")
