"""Run Spark queries and their DuckDB oracles side by side and compare.

    python -m tests.oracle_check [sf_dir] [name ...]

Comparison: same column-name set, same row count, same multiset of rows
after normalising values (decimals -> float, dates/timestamps -> ISO
text, floats rounded to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v)


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    res = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            res[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, res[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in orc:
            res[name] = f"rows-only ({len(srows)} rows, {ts:.1f}s)"
            print(name, res[name], flush=True)
            continue
        try:
            rel = con.sql(orc[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            res[name] = f"DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, res[name], flush=True)
            continue
        if sorted(scols) != sorted(dcols):
            res[name] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        elif len(srows) != len(drows):
            res[name] = f"ROWCOUNT spark={len(srows)} duck={len(drows)}"
        else:
            a, b = rows_key(scols, srows), rows_key(dcols, drows)
            if a == b:
                res[name] = f"OK ({len(srows)} rows, {ts:.1f}s)"
            else:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                res[name] = f"VALUES differ, e.g. {diff}"
        print(name, res[name], flush=True)
    return res


if __name__ == "__main__":
    from tidewater.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    r = compare(spark, sf, names)
    bad = {k: v for k, v in r.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"\n{len(r) - len(bad)}/{len(r)} ok")
