"""Runs registered queries and their SQL side by side and compares rows without regard to order."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalogue.registry import ORACLES, QUERIES, TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) if not value.is_integer() else int(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(r[i]) for i in at) for r in rows]
    return [columns[i] for i in at], sorted(picked, key=repr)


def run_both(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    mine = ordered(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return mine, None
    cursor = con.execute(ORACLES[name])
    return mine, ordered([d[0] for d in cursor.description], cursor.fetchall())


def main(sf_dir, names):
    from conftest import session

    spark, con = session(), connect(sf_dir)
    bad = []
    for name in names or list(QUERIES):
        start = time.time()
        try:
            mine, oracle = run_both(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            print(f"{name}: ERROR {str(error)[:1500]}")
            bad.append(name)
            continue
        took = time.time() - start
        if oracle is None:
            print(f"{name}: rows only, {len(mine[1])} rows, {took:.1f}s")
        elif mine == oracle:
            print(f"{name}: ok, {len(mine[1])} rows, {took:.1f}s")
        else:
            bad.append(name)
            print(f"{name}: DIFFERS columns {mine[0]} / {oracle[0]}, {len(mine[1])} / {len(oracle[1])}")
            a, b = set(map(repr, mine[1])), set(map(repr, oracle[1]))
            for row in sorted(a - b)[:3]:
                print("   spark ", row[:700])
            for row in sorted(b - a)[:3]:
                print("   oracle", row[:700])
    print("bad:", bad)


if __name__ == "__main__":
    import catalogue  # noqa: F401

    main(sys.argv[1], sys.argv[2:])
