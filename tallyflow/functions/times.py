"""Dates, epochs and business days as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def day(value: str) -> Column:
    return F.lit(value).cast("date")


def days_before(as_of: str, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def day_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def second_text(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def within(as_of: str, days: int, dt: str = "dt") -> Column:
    """The ``days`` business dates that end on ``as_of``."""
    return F.col(dt).between(days_before(as_of, days - 1), day(as_of))


def epoch_ms(ts: str) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp."""
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, {ts})")


def from_epoch_ms(ms: str, zone: str = "UTC") -> Column:
    """Wall clock of ``zone`` for an epoch in ms; does not depend on the session zone."""
    utc = f"timestampadd(MILLISECOND, cast({ms} as bigint), {EPOCH})"
    return F.expr(f"convert_timezone('UTC', '{zone}', {utc})")


def epoch_any(text: str) -> Column:
    """Epoch given in seconds or milliseconds, told apart by the number of digits."""
    number = f"try_cast({text} as bigint)"
    return F.expr(
        f"timestampadd(MILLISECOND, if({number} < 10000000000, {number} * 1000, {number}), {EPOCH})"
    )


def epoch_day(number: Column | str) -> Column:
    return F.date_add(day("1970-01-01"), F.col(number).cast("int") if isinstance(number, str) else number)


def iso_text(col: Column | str) -> Column:
    """``2025-07-12T10:11:12Z`` → ``2025-07-12 10:11:12``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))


def is_weekend(col: Column | str) -> Column:
    return F.dayofweek(col).isin(1, 7)


def day_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day as ``yyyyMMdd``, both ends included."""
    days = F.explode(F.sequence(day(first), day(last)))
    return spark.range(1).select(days.alias("d")).select(F.date_format("d", "yyyyMMdd").alias("ds"))
