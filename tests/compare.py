"""Run a query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb

from catalogue import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(_norm(x) for x in v.values())
    return v


def _key(row):
    return tuple((x is None, type(x).__name__ if not isinstance(x, (int, float)) else "n", str(x) if not isinstance(x, (int, float)) else x) for x in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_norm(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(row[i]) for i in order) for row in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def difference(spark, folder: str, name: str) -> str | None:
    """Null if both sides agree in names, types and values, else what differs."""
    s_names, s = spark_rows(QUERIES[name](spark, folder))
    d_names, d = duck_rows(duck(folder), ORACLES[name])
    if s_names != d_names:
        return f"columns {s_names} / {d_names}"
    if len(s) != len(d):
        return f"rows {len(s)} / {len(d)}"
    for a, b in zip(s, d):
        for n, x, y in zip(s_names, a, b):
            if x != y or (x is not None and type(x) is not type(y)):
                return f"{n}: {x!r} / {y!r} in {a} / {b}"
    return None


if __name__ == "__main__":
    from linenet.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(**{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="linenet-")})
    bad = 0
    for name in names:
        t0, n = time.time(), ""
        try:
            if name in ORACLES:
                diff = difference(spark, folder, name)
                n = ""
            else:
                diff, n = None, QUERIES[name](spark, folder).count()
                n = f"{n} rows" + ("" if n else " EMPTY")
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - t0:.1f}s {n} {str(diff)[:1800] if diff else ''}", flush=True)
    print("failed:", bad)
