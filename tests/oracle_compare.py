"""Run registered Spark queries and their DuckDB twins side by side.

Usage: ``python -m tests.oracle_compare [sf_dir] [name-substring ...]``.
Prints one line per query: rows, schema match, value match, seconds.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=repr)


def compare(spark, sf_dir: str, names=None, verbose: bool = True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name, fn in qs.items():
        if names and not any(n in name for n in names):
            continue
        t0 = time.time()
        try:
            scols, srows = rows_of_spark(fn(spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            out[name] = ("SPARK-ERROR", repr(e)[:300])
            print(name, "SPARK-ERROR", repr(e)[:2000], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            out[name] = ("rows-only", len(srows))
            print(f"{name:40s} rows={len(srows):7d} (no sql) {ts:6.1f}s", flush=True)
            continue
        try:
            dcols, drows = rows_of_duck(con, sqls[name])
        except Exception as e:  # noqa: BLE001
            out[name] = ("DUCK-ERROR", repr(e)[:300])
            print(name, "DUCK-ERROR", repr(e)[:2000], flush=True)
            continue
        ok = scols == dcols and srows == drows
        out[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:40s} rows={len(srows):7d}/{len(drows):7d} cols={'ok' if scols == dcols else 'DIFF'} "
              f"{'OK' if ok else 'MISMATCH'} {ts:6.1f}s", flush=True)
        if not ok and verbose:
            if scols != dcols:
                print("   spark cols", scols, "\n   duck cols ", dcols)
            else:
                sset, dset = set(srows), set(drows)
                print("   only spark:", list(sset - dset)[:3])
                print("   only duck: ", list(dset - sset)[:3])
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from tokenloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    res = compare(spark, sf, sys.argv[2:])
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("SUMMARY", len(res), "queries,", len(bad), "not ok:", bad)
