"""Retail dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyflow.functions import clean
from tallyflow.operators.dims import attribute_sets, dictionary_roles, enrich

# Fixed value: accepted mobile numbers and mail addresses.
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
MAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def activity(rule: DataFrame, info: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = enrich(rule, info, "activity_id", "id", {"activity_name": "activity_name"})
    typed = dictionary_roles(named, dictionary, {"activity_type": "activity_type_name"})
    return typed.select(
        F.col("id").alias("activity_rule_id"),
        "activity_id",
        "activity_name",
        F.col("activity_type").alias("activity_type_code"),
        "activity_type_name",
        "condition_amount",
        "condition_num",
        "benefit_amount",
        "benefit_discount",
        clean.activity_benefit("activity_type", "condition_amount", "condition_num", "benefit_amount", "benefit_discount").alias("benefit_rule"),
        "benefit_level",
    )


def coupon(info: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Coupon type and range looked up in the same dictionary under two roles."""
    named = dictionary_roles(info, dictionary, {"coupon_type": "coupon_type_name", "range_type": "range_type_name"})
    return named.select(
        "id",
        "coupon_name",
        F.col("coupon_type").alias("coupon_type_code"),
        "coupon_type_name",
        "condition_amount",
        "condition_num",
        "benefit_amount",
        "benefit_discount",
        clean.coupon_benefit("coupon_type", "condition_amount", "condition_num", "benefit_amount", "benefit_discount").alias("benefit_rule"),
        F.col("range_type").alias("range_type_code"),
        "range_type_name",
    )


def snapshot(rows: DataFrame, columns: list[str], as_of: str) -> DataFrame:
    """Plain daily copy (promotion positions, promotion referrers)."""
    return rows.select(*columns, F.lit(as_of).cast("date").alias("dt"))


def province(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    return enrich(provinces, regions, "region_id", "id", ["region_name"]).withColumnRenamed("name", "province_name")


def sku(sku_info: DataFrame, spu: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame, tm: DataFrame, attrs: DataFrame, sale_attrs: DataFrame) -> DataFrame:
    """Goods with product, three category levels, brand and both attribute sets."""
    out = enrich(sku_info, spu, "spu_id", "id", ["spu_name"])
    out = enrich(out, c3, "category3_id", "id", {"name": "category3_name", "category2_id": "category2_id"})
    out = enrich(out, c2, "category2_id", "id", {"name": "category2_name", "category1_id": "category1_id"})
    out = enrich(out, c1, "category1_id", "id", {"name": "category1_name"})
    out = enrich(out, tm, "tm_id", "id", ["tm_name"])
    sets = attribute_sets(attrs, "sku_id", ["attr_id", "value_id", "attr_name", "value_name"], "attrs")
    sale_sets = attribute_sets(sale_attrs, "sku_id", ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"], "sale_attrs")
    out = enrich(out, sets, "id", "sku_id", ["attrs"])
    return enrich(out, sale_sets, "id", "sku_id", ["sale_attrs"])


def sku_names(sku_info: DataFrame, c3: DataFrame, c2: DataFrame, c1: DataFrame, tm: DataFrame) -> DataFrame:
    """The part of the goods dimension the summaries use."""
    out = enrich(sku_info.select("id", "sku_name", "category3_id", "tm_id"), c3, "category3_id", "id", {"name": "category3_name", "category2_id": "category2_id"})
    out = enrich(out, c2, "category2_id", "id", {"name": "category2_name", "category1_id": "category1_id"})
    out = enrich(out, c1, "category1_id", "id", {"name": "category1_name"})
    return enrich(out, tm, "tm_id", "id", ["tm_name"])


def masked_user(users: DataFrame) -> DataFrame:
    """Personal data hidden; malformed numbers and addresses become NULL."""
    phone: Column = clean.mask_phone("phone_num", PHONE)
    mail: Column = F.when(F.col("email").rlike(MAIL), clean.mask_email("email"))
    return users.withColumns({"name": clean.mask_name("name"), "phone_num": phone, "email": mail})


def dates(days: DataFrame) -> DataFrame:
    """Date dimension from one row per day."""
    d = F.col("date_id")
    return days.select(
        "date_id",
        F.weekofyear(d).alias("week_id"),
        (F.weekday(d) + 1).alias("week_day"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.weekday(d) < 5).cast("int").alias("is_workday"),
    )
