"""Side-by-side check: a registered Spark query vs its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an
order-insensitive comparison of values (columns sorted by name).
Usage: ``python tests/harness.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir, exact=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    info = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(scols) != sorted(dcols):
        info["error"] = f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}"
        return info
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        info["error"] = f"values differ (first): {diff}"
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from costweave.session import local_spark
    from costweave.plans import registry
    registry.load_all()
    spark = local_spark()
    con = duck(sf_dir)
    bad = 0
    for name, sql in registry.ORACLE.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, name, registry.QUERIES[name], sql, sf_dir)
        except Exception as e:  # report and continue
            info = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += "error" in info
        print(info, flush=True)
    missing = [n for n in registry.QUERIES if n not in registry.ORACLE]
    print(f"checked={len([n for n in registry.ORACLE if not names or n in names])} bad={bad} "
          f"no_oracle={missing}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
