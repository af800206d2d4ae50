"""All registered queries: name → (spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyflow.catalog import goods, pages, parcel, retail, streams, tables
from tallyflow.catalog.shape import plain

FAMILIES = [
    (retail.RetailWarehouse, retail.QUERIES),
    (parcel.ParcelWarehouse, parcel.QUERIES),
    (goods.GoodsWarehouse, goods.GOODS_QUERIES),
    (goods.NewGoodsWarehouse, goods.NEW_QUERIES),
    (goods.OfferWarehouse, goods.OFFER_QUERIES),
    (pages.PathWarehouse, pages.PATH_QUERIES),
    (pages.AnalyticsWarehouse, pages.ANALYTICS_QUERIES),
    (streams.StreamWarehouse, streams.QUERIES),
    (tables.TableWarehouse, tables.QUERIES),
]


def _runner(warehouse, build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir)))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for warehouse, queries in FAMILIES:
        for name, build in queries.items():
            if name in out:
                raise ValueError(f"{name} registered twice")
            out[name] = _runner(warehouse, build)
    return out
