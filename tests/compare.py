"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

    python tests/compare.py [sf_dir] [key ...]

Compares row count, column names and the multiset of rows (floats rounded).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_mismatches(spark_dtypes, con, sql):
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    st = dict(spark_dtypes)
    return [(c, st.get(c), duck_types.get(c)) for c in sorted(set(st) | set(duck_types))
            if SPARK_TO_DUCK.get(st.get(c), st.get(c)) != duck_types.get(c)]


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], sorted(columns)


def compare(spark, sf_dir: str, keys=None, verbose=True):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            s_rows, s_cols = rows_of(df.columns, srows)
        except Exception as e:  # noqa: BLE001
            results[k] = ("spark-error", str(e)[:400])
            if verbose:
                print(f"{k:24s} SPARK ERROR {str(e)[:400]}")
            continue
        t_spark = time.time() - t
        if k not in sql:
            results[k] = ("no-oracle", len(s_rows))
            if verbose:
                print(f"{k:24s} rows={len(s_rows)} (no oracle)")
            continue
        try:
            cur = con.execute(sql[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            d_rows, d_cols = rows_of(dcols, drows)
        except Exception as e:  # noqa: BLE001
            results[k] = ("duck-error", str(e)[:400])
            if verbose:
                print(f"{k:24s} DUCKDB ERROR {str(e)[:600]}")
            continue
        ok_cols = s_cols == d_cols
        ok_n = len(s_rows) == len(d_rows)
        cs, cd = Counter(s_rows), Counter(d_rows)
        ok_v = cs == cd
        bad_types = type_mismatches(df.dtypes, con, sql[k])
        ok = ok_cols and ok_n and ok_v and not bad_types
        results[k] = ("ok" if ok else "mismatch", len(s_rows), len(d_rows), bad_types)
        if verbose:
            status = "OK " if results[k][0] == "ok" else "BAD"
            print(f"{k:24s} {status} spark={len(s_rows)} duck={len(d_rows)} cols={'ok' if ok_cols else (s_cols, d_cols)} "
                  f"types={bad_types or 'ok'} {t_spark:.1f}s")
            if not ok_v and ok_cols:
                only_s = list((cs - cd).elements())[:5]
                only_d = list((cd - cs).elements())[:5]
                print("   cols:", s_cols)
                for r in only_s:
                    print("   spark-only:", r)
                for r in only_d:
                    print("   duck-only: ", r)
    return results


if __name__ == "__main__":
    from ledgerlint.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    print(f"{len(res) - len(bad)}/{len(res)} ok; not ok: {sorted(bad)}")
