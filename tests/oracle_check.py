"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values with columns sorted by name.

    python -m tests.oracle_check --sf /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import json
import math
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')"
        )
    return con


def _cell(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return _cell(float(v))
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        ts = pd.Timestamp(v)
        ts = ts.tz_convert("UTC").tz_localize(None) if ts.tzinfo else ts
        # DuckDB hands DATE columns to pandas as midnight timestamps.
        return ts.date().isoformat() if ts == ts.normalize() else ts.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _cell(v.tolist())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def fingerprint(df: pd.DataFrame) -> tuple[int, list[str], str, list[str]]:
    cols = sorted(df.columns)
    rows = sorted(
        "|".join(_cell(r[c]) for c in cols)
        for r in df[cols].astype(object).where(pd.notna(df[cols]), None).to_dict("records")
    )
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(df), cols, h, rows


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        rec: dict = {}
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
            rec["spark_rows"] = len(sdf)
            rec["spark_sec"] = round(time.time() - t0, 2)
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"spark: {type(e).__name__}: {str(e)[:400]}"
            report[name] = rec
            if verbose:
                print(name, rec, flush=True)
            continue
        if name in sqls:
            try:
                odf = con.execute(sqls[name]).df()
            except Exception as e:  # noqa: BLE001
                rec["error"] = f"duckdb: {type(e).__name__}: {str(e)[:400]}"
                report[name] = rec
                if verbose:
                    print(name, rec, flush=True)
                continue
            n1, c1, h1, r1 = fingerprint(sdf)
            n2, c2, h2, r2 = fingerprint(odf)
            rec.update(rows_match=n1 == n2, cols_match=c1 == c2, hash_match=h1 == h2)
            rec["oracle_rows"] = n2
            if c1 != c2:
                rec["cols"] = [c1, c2]
            elif h1 != h2:
                a, b = set(r1) - set(r2), set(r2) - set(r1)
                rec["diff"] = [sorted(a)[:2], sorted(b)[:2], len(a), len(b)]
        else:
            rec["oracle"] = "none (rows-only)"
        report[name] = rec
        if verbose:
            print(name, json.dumps(rec, default=str)[:1500], flush=True)
    return report


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sys.path.insert(0, "/root/repo")
    from tripflow.session import local_session

    spark = local_session()
    rep = compare(spark, args.sf, args.names or None)
    bad = [k for k, v in rep.items() if "error" in v or v.get("hash_match") is False]
    print("FAILED:", bad)
    print(f"{len(rep) - len(bad)}/{len(rep)} ok")


if __name__ == "__main__":
    main()
