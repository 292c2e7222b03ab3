"""Compare each registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]

Row count, column names and order-insensitive values are compared; doubles
match within a relative tolerance of 1e-6, NULL == NaN.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == 0:
            return 0.0
        return float(v)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(x):
    if isinstance(x, float):
        return (1, "", float(f"{x:.4g}"))
    return (x is None, str(type(x)), x if x is not None else 0)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple(_key(x) for x in r))


def _close(x, y):
    if isinstance(x, float) and isinstance(y, float):
        return abs(x - y) <= 1e-6 * max(1.0, abs(x), abs(y))
    if isinstance(x, tuple) and isinstance(y, tuple):
        return len(x) == len(y) and all(_close(a, b) for a, b in zip(x, y))
    return x == y


def _same(a, b):
    return all(len(x) == len(y) and all(_close(p, q) for p, q in zip(x, y)) for x, y in zip(a, b))


def compare(name, spark, sf_dir, con, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark-only={sorted(set(scols)-set(dcols))} "
                        f"oracle-only={sorted(set(dcols)-set(scols))}")
    if len(srows) != len(drows):
        problems.append(f"row count spark={len(srows)} oracle={len(drows)}")
    if not problems:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        if not _same(a, b):
            diff = [(x, y) for x, y in zip(a, b) if not _same([x], [y])][:3]
            names = sorted(scols)
            problems.append("values differ; first diffs:\n" + "\n".join(
                "  spark : " + str(dict(zip(names, x))) + "\n  oracle: " + str(dict(zip(names, y)))
                for x, y in diff))
    return problems, len(srows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from pyspark.sql import SparkSession
    import __spark_entry__ as E
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in (names or list(qs)):
        if n not in sqls:
            try:
                df = qs[n](spark, sf_dir)
                print(f"ROWS  {n}: {df.count()} rows (no oracle)", flush=True)
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"FAIL {n}: error: {type(e).__name__}: {str(e)[:600]}", flush=True)
            continue
        try:
            probs, nrows, ts, td = compare(n, spark, sf_dir, con, qs[n], sqls[n])
        except Exception as e:  # noqa: BLE001
            probs, nrows, ts, td = [f"error: {type(e).__name__}: {str(e)[:600]}"], -1, 0, 0
        status = "OK  " if not probs else "FAIL"
        bad += bool(probs)
        print(f"{status} {n}: rows={nrows} spark={ts:.1f}s duck={td:.1f}s", flush=True)
        for p in probs:
            print("     " + p, flush=True)
    print(f"{bad} failing", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
