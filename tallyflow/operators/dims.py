"""Dimension joins. No broadcast hints: AQE broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges with skew splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(facts: DataFrame, dim: DataFrame, on: str, key: str = "id", columns: Mapping[str, str] | Sequence[str] = (), default=None) -> DataFrame:
    """Left join of named dimension columns (``{source: output}``), absent rows filled with ``default``."""
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    side = dim.select(F.col(key).alias("_key"), *[F.col(s).alias(f"_{o}") for s, o in names.items()])
    joined = facts.join(side, facts[on] == F.col("_key"), "left")
    filled = lambda o: F.coalesce(F.col(f"_{o}"), F.lit(default)) if default is not None else F.col(f"_{o}")
    return joined.select(*[facts[c] for c in facts.columns if c not in names.values()], *[filled(o).alias(o) for o in names.values()])


def dictionary_roles(facts: DataFrame, dictionary: DataFrame, roles: Mapping[str, str], default=None) -> DataFrame:
    """One code dictionary joined once per role: ``{code column: name column}``."""
    out = facts
    for code, name in roles.items():
        out = enrich(out, dictionary, code, "dic_code", {"dic_name": name}, default)
    return out


def region_chain(facts: DataFrame, regions: DataFrame, on: str, levels: Sequence[str]) -> DataFrame:
    """Walk ``parent_id`` upwards from ``on``: adds ``<level>_id`` and ``<level>_name`` for each level."""
    out, at = facts, on
    for level in levels:
        side = regions.select(
            F.col("id").alias(f"_{level}"), F.col("name").alias(f"{level}_name"), F.col("parent_id").alias(f"{level}_parent")
        )
        out = out.join(side, out[at] == side[f"_{level}"], "left").withColumn(f"{level}_id", F.col(f"_{level}")).drop(f"_{level}")
        at = f"{level}_parent"
    return out.drop(*[f"{level}_parent" for level in levels])


def attribute_sets(rows: DataFrame, key: str, fields: Sequence[str], out: str) -> DataFrame:
    """Distinct attribute structs per key in a fixed order."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*fields))).alias(out))


def distribution_map(rows: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """value → row count as a map: counted first, so a map holds one entry per distinct value."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(value), F.col("_n"))))
    return counted.groupBy(*keys).agg(F.map_from_entries(pairs).alias(out))


def map_text(col: str) -> Column:
    """Map as ``k:v,k:v`` in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(col)), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
