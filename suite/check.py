"""Run registered queries and their SQL side by side: ``python -m suite.check [folder] [key ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    if isinstance(x, dt.datetime) and (x.hour, x.minute, x.second, x.microsecond) == (0, 0, 0, 0):
        return str(x.date())
    if isinstance(x, (dt.date, dt.datetime)):
        return str(x)
    if isinstance(x, dict):
        return str({k: _plain(v) for k, v in x.items()})
    if isinstance(x, (list, tuple)):
        return str([_plain(v) for v in x])
    return x


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in t))


def compare(key, spark, con, folder, queries, oracles):
    """(verdict, row count, seconds); the verdict is 'ok', 'close' or a reason."""
    start = time.time()
    df = queries[key](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if key not in oracles:
        return "no sql", len(rows), took
    cur = con.execute(oracles[key])
    cols, mine = normalised(df.columns, rows)
    ocols, theirs = normalised([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} / {ocols}", len(rows), took
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}", len(rows), took
    exact = True
    for a, b in zip(mine, theirs):
        for name, x, y in zip(cols, a, b):
            if x == y:
                continue
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                exact = False
                continue
            return f"{name}: {x!r} / {y!r} in {dict(zip(cols, a))} / {dict(zip(cols, b))}", len(rows), took
    return ("ok" if exact else "close"), len(rows), took


def main(argv):
    from seepline.session import local_session
    from suite import registry

    folder = "/root/testdata/sf0.01"
    if argv and "/" in argv[0]:
        folder, argv = argv[0], argv[1:]
    spark = local_session("check", cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = registry.queries(), registry.oracle_sql()
    bad = 0
    for key in argv or queries:
        try:
            verdict, n, took = compare(key, spark, con, folder, queries, oracles)
        except Exception as e:  # noqa: BLE001
            verdict, n, took = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += verdict not in ("ok", "no sql")
        print(f"{key:28s} {n:8d} {took:6.2f}s  {verdict}", flush=True)
    print(f"{len(argv or queries)} queries, {bad} to look at")


if __name__ == "__main__":
    main(sys.argv[1:])
