"""Cleaning, masking and coding of raw columns; all JVM-side expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def default_fill(col: Column | str, default) -> Column:
    """Empty text and NULL become ``default``."""
    c = _c(col)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def clamp(col: Column | str, low, high, otherwise=None) -> Column:
    """Value inside [low, high]; outside it the nearest bound, or ``otherwise`` when given."""
    c = _c(col)
    if otherwise is None:
        return F.greatest(F.least(c, F.lit(high)), F.lit(low))
    return F.when(c.between(low, high), c).otherwise(F.lit(otherwise))


def code_to_name(col: Column | str, names: Mapping, default: str | None = None) -> Column:
    """CASE over a fixed code list."""
    c, out = _c(col), None
    for code, name in names.items():
        out = F.when(c == code, name) if out is None else out.when(c == code, name)
    return out.otherwise(F.lit(default))


def keyword_category(col: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose keyword occurs in the text wins."""
    c, out = _c(col), None
    for keyword, category in rules:
        out = F.when(c.contains(keyword), category) if out is None else out.when(c.contains(keyword), category)
    return out.otherwise(default)


def tier(col: Column | str, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """First step whose bound is exceeded wins; give the steps from high to low."""
    c, out = _c(col), None
    for bound, name in steps:
        out = F.when(c > bound, name) if out is None else out.when(c > bound, name)
    return out.otherwise(default)


# Rule type codes and the texts they are shown with.
ACTIVITY_AMOUNT, ACTIVITY_COUNT, ACTIVITY_DISCOUNT = "3101", "3102", "3103"
COUPON_AMOUNT, COUPON_COUNT, COUPON_DIRECT = "3201", "3202", "3203"


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def activity_benefit(kind: str, amount: str, count: str, cut: str, discount: str) -> Column:
    """Readable rule of an activity."""
    k, cut, discount = F.col(kind), F.col(cut), F.col(discount)
    return (
        F.when(k == ACTIVITY_AMOUNT, _text("满", F.col(amount), "元减", cut, "元"))
        .when(k == ACTIVITY_COUNT, _text("满", F.col(count), "件打", discount, "折"))
        .when(k == ACTIVITY_DISCOUNT, _text("打", discount, "折"))
    )


def coupon_benefit(kind: str, amount: str, count: str, cut: str, discount: str) -> Column:
    """Readable rule of a coupon."""
    k, cut, discount = F.col(kind), F.col(cut), F.col(discount)
    return (
        F.when(k == COUPON_AMOUNT, _text("满", F.col(amount), "元减", cut, "元"))
        .when(k == COUPON_COUNT, _text("满", F.col(count), "件打", discount, "折"))
        .when(k == COUPON_DIRECT, _text("减", cut, "元"))
    )


def event_id(*parts: Column | str, time: Column | str) -> Column:
    """Key parts joined with the digits of the event time."""
    return F.concat_ws("_", *[_c(p).cast("string") for p in parts], F.regexp_replace(_c(time).cast("string"), "[^0-9]", ""))


def mask_name(col: Column | str) -> Column:
    return F.concat(F.substring(_c(col), 1, 1), F.lit("*"))


def mask_name_full(col: Column | str) -> Column:
    """First character kept, every other one replaced."""
    c = _c(col)
    return F.concat(F.substring(c, 1, 1), F.repeat(F.lit("*"), F.greatest(F.length(c) - 1, F.lit(0))))


def mask_phone(col: Column | str, pattern: str = r"^1[0-9]{10}$") -> Column:
    """Three leading and the last digits from the eighth on; NULL when not a phone number."""
    c = _c(col)
    return F.when(c.rlike(pattern), F.concat(F.substring(c, 1, 3), F.lit("****"), F.substr(c, F.lit(8))))


def mask_email(col: Column | str) -> Column:
    """Local part hidden; NULL when there is no domain."""
    c = _c(col)
    return F.when(c.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.concat(F.lit("*@"), F.split_part(c, F.lit("@"), F.lit(2))))


def match_or_null(col: Column | str, pattern: str) -> Column:
    c = _c(col)
    return F.when(c.rlike(pattern), c)


def strip_control(col: Column | str) -> Column:
    return F.regexp_replace(F.trim(_c(col)), r"[\x00-\x1F\x7F]", "")


def hash_sensitive(col: Column | str) -> Column:
    return F.md5(_c(col).cast("string"))


# Hot addresses with a bucket of their own.
HOT_ADDRESS_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_bucket(col: Column | str, buckets: int = 128, overrides: Mapping[str, str] | None = None) -> Column:
    """Four-digit bucket from the last three hex digits of the md5; named hot keys get buckets of their own."""
    c = _c(col).cast("string")
    tail = F.conv(F.right(F.md5(c), F.lit(3)), 16, 10).cast("bigint")
    bucket = F.lpad((tail % buckets).cast("string"), 4, "0")
    if not overrides:
        return bucket
    return F.coalesce(code_to_name(F.lower(c), overrides), bucket)


@F.pandas_udf(StringType())
def _plain_number(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: str(int(t, 16)) if t.startswith("0x") else t, na_action="ignore")


def hex_to_plain(col: Column | str) -> Column:
    """``0x…`` of any length or decimal text as plain decimal text; NULL gives "0"."""
    return F.coalesce(_plain_number(_c(col)), F.lit("0"))


def hex_to_number(col: Column | str, divide: bool = False) -> Column:
    """The same as decimal(38,0) without leaving the JVM; ``divide`` scales by 10^18. NULL where the value does not fit.

    Leading zeros go first, so any number of digits is read. ``conv`` holds 64 bits, so the value is put together from a head of
    up to two hex digits and two parts of 15.
    """
    c = F.coalesce(F.lower(F.trim(_c(col))), F.lit("0"))
    digits = F.regexp_replace(F.regexp_replace(c, "^0x", ""), "^0+", "")
    wide = F.when((F.length(digits) <= 32) & digits.rlike("^[0-9a-f]*$"), F.lpad(digits, 32, "0"))
    part = lambda start, size: F.conv(F.substring(wide, start, size), 16, 10).cast("decimal(38,0)")
    step = F.lit(str(16**15)).cast("decimal(38,0)")
    # 10^38 needs 127 bits: heads from 0x4b on, and a few values below them, do not fit and end as NULL
    upper = part(1, 2) * F.lit(16**15).cast("decimal(19,0)") + part(3, 15)
    whole = F.try_add(F.try_multiply(upper.cast("decimal(38,0)"), step), part(18, 15))
    value = F.when(c.startswith("0x"), whole.try_cast("decimal(38,0)")).otherwise(c.try_cast("decimal(38,0)"))
    return value.cast("double") / F.lit(1e18) if divide else value


def has_only(col: Column | str, allowed: str = r"^[A-Za-z0-9_]+$") -> Column:
    return F.coalesce(_c(col).rlike(allowed), F.lit(False))


def is_blank(col: Column | str) -> Column:
    return F.coalesce(F.trim(_c(col)), F.lit("")) == ""


def list_text(col: Column | str) -> Column:
    return F.array_join(_c(col), ",")


def append_json(col: Column | str, value: Column | str) -> Column:
    """Append a text to a JSON list of texts; NULL or empty starts a new list."""
    held = F.coalesce(F.from_json(_c(col), "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.array_append(held, _c(value)))
