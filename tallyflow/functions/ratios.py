"""Zero-safe rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(num: Column | str, den: Column | str, default: float | None = 0.0) -> Column:
    """num / den as double; ``default`` when the denominator is 0 or NULL."""
    out = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def rate(num: Column | str, den: Column | str, digits: int = 4, default: float | None = 0.0) -> Column:
    return F.round(ratio(num, den, default), digits)


def percent(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return F.round(ratio(num, den) * 100, digits)
