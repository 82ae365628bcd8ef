"""Run registered queries next to their SQL twins: python tests/compare.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from anagrove.session import stages  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, run, sql, sf_dir):
    """None when equal, else a short account of the difference."""
    with stages(spark):
        df = run(spark, sf_dir)
        names, ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if ours else "no rows"
    cursor = con.execute(sql)
    twin_names, theirs = canonical([c[0] for c in cursor.description], cursor.fetchall())
    if names != twin_names:
        return f"columns {names} != {twin_names}"
    if ours != theirs:
        mine, other = set(map(repr, ours)), set(map(repr, theirs))
        only = sorted(mine - other)[:3], sorted(other - mine)[:3]
        return f"rows {len(ours)} != {len(theirs)}; only ours {only[0]}; only theirs {only[1]}"
    return None


def main() -> int:
    from conftest import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    chosen = sys.argv[2:] or list(entry.queries())
    spark, con = build_session(), open_tables(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name in chosen:
        start = time.time()
        try:
            found = compare(spark, con, name, entry.queries()[name], oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in oracles else "rows"
        print(f"{'ok ' if found is None else 'BAD'} {kind:4} {name:28} {time.time() - start:6.2f}s", found or "", flush=True)
        bad += found is not None
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
