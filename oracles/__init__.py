"""DuckDB statements each registered query is compared with."""

from oracles import goods, pages, parcel, retail, streams, tables


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for family in (retail, parcel, goods, pages, streams, tables):
        out.update(family.SQL)
    return out
