"""Numeric and time columns with the same results on every engine."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, as double: binary rounding differs between engines."""
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def ratio(part: Column, whole: Column, default: float | None = 0.0) -> Column:
    """part / whole where whole is positive; else the default."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(default))


def minutes_between(a: Column, b: Column) -> Column:
    """Minutes from a to b; works on timestamps with and without zone."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / F.lit(60_000_000.0)


def hours_between(a: Column, b: Column) -> Column:
    return minutes_between(a, b) / 60.0


def shift(t: Column, minutes: float) -> Column:
    """t plus some minutes (may be negative)."""
    return t + F.expr(f"interval {round(minutes * 60)} seconds")


def null_outside(x: Column, low: float, high: float) -> Column:
    """x within [low, high], else null."""
    return F.when(x.between(low, high), x)


def first_match(rungs: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first condition that holds; a null condition doesn't hold."""
    (condition, value), *rest = rungs
    out = F.when(condition, F.lit(value))
    for condition, value in rest:
        out = out.when(condition, F.lit(value))
    return out.otherwise(F.lit(default))
