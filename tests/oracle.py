"""Compare a registered query with its SQL: columns, types and every row."""

from __future__ import annotations

import math
import time
from datetime import date, datetime
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_KINDS = {
    "bigint": "int", "int": "int", "integer": "int", "hugeint": "int", "smallint": "int", "double": "float", "float": "float",
    "string": "text", "varchar": "text", "timestamp_ntz": "time", "timestamp": "time", "date": "date", "boolean": "bool",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    return "decimal" if dtype.startswith("decimal") else _KINDS.get(dtype, dtype)


def _value(v):
    if isinstance(v, (float, Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else f"{v:.6f}".replace("-0.000000", "0.000000")
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return "<null>" if v is None else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    out = {"name": name, "rows": len(got), "sec": round(time.time() - start, 2), "ok": bool(got), "why": "" if got else "no rows"}
    if sql is None:
        return out
    con.execute(f"CREATE OR REPLACE TEMP TABLE __want AS {sql}")
    types = {r[0]: _kind(r[1]) for r in con.execute("DESCRIBE __want").fetchall()}
    want_columns = list(types)
    want = con.execute("SELECT * FROM __want").fetchall()
    have = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    problems = []
    if have != types:
        problems.append(f"schema {sorted(set(have.items()) ^ set(types.items()))}")
    elif len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if have.keys() == types.keys():
        a, b = _rows(df.columns, got), _rows(want_columns, want)
        if a != b:
            sa, sb = set(a), set(b)
            problems.append(f"values {sorted(have)}: only spark {sorted(sa - sb)[:3]} only sql {sorted(sb - sa)[:3]} ({len(sa - sb)}/{len(sb - sa)})")
    out["ok"], out["why"] = out["ok"] and not problems, "; ".join(problems)
    return out


if __name__ == "__main__":
    import sys

    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in chosen or queries:
        try:
            r = compare(spark, con, sf_dir, name, queries[name], oracles.get(name))
        except Exception as error:
            r = {"name": name, "rows": -1, "sec": 0, "ok": False, "why": str(error)[:1500]}
        bad += not r["ok"]
        print(f"{'ok ' if r['ok'] else 'BAD'} {r['name']:30} rows={r['rows']:7} {r['sec']}s {'' if name in oracles else '(rows only)'} {r['why']}", flush=True)
    print(f"{len(chosen or queries)} queries, {bad} bad")
