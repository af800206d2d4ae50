"""Run registered queries beside their SQL and compare names, types and values.

    python -m tests.compare [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return ("f", round(v, 9) + 0.0)
    return (type(v).__name__, v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def _same(a, b, ties: bool) -> bool:
    """Equal cells; with ``ties`` a rounded rate may differ by one unit of its second digit, as engines round exact halves differently."""
    if a == b:
        return True
    floats = isinstance(a, tuple) and isinstance(b, tuple) and a[0] == b[0] == "f"
    return ties and floats and abs(a[1] - b[1]) < 0.0101 and all(abs(round(x[1], 2) - x[1]) < 1e-9 for x in (a, b))


def differences(spark_df, con, sql, ties: bool = False) -> str | None:
    got_names, got = rows_of(spark_df.columns, spark_df.collect())
    res = con.execute(sql)
    want_names, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if not want:
        return "both sides empty"
    if len(got) != len(want):
        known = set(want)
        extra = [r for r in got if r not in known][:2]
        return f"rows {len(got)} != {len(want)}; extra {extra}"
    for g, w in zip(got, want):
        bad = [(n, a, b) for n, a, b in zip(got_names, g, w) if not _same(a, b, ties)]
        if bad:
            return f"values {bad[:4]} in {g} / {w}"[:900]
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tallyflow.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            if name in sqls:
                note = differences(run(spark, sf_dir), con, sqls[name])
                n = ""
            else:
                n = run(spark, sf_dir).count()
                note = None if n else "no rows"
                n = f"rows only: {n}"
        except Exception as e:  # noqa: BLE001
            note, n = f"{type(e).__name__}: {' '.join(str(e).split())[:600]}", ""
        bad += note is not None
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - t:.1f}s {n} {note or ''}", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
