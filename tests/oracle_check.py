"""Run queries at a scale and compare each with its DuckDB oracle the way
the driver does: same column names, same row count, and equal values with
row order ignored (columns sorted by name)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(float(v)))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return (1, str(int(v)))
    if isinstance(v, int):
        return (1, repr(float(v)))
    return (1, str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    res = con.execute(sql)
    exp_cols = [d[0] for d in res.description]
    exp = res.fetchall()
    g, gcols = rows_of(df.columns, [tuple(r) for r in got])
    e, ecols = rows_of(exp_cols, exp)
    ok = gcols == ecols and len(g) == len(e) and g == e
    detail = ""
    if not ok:
        if gcols != ecols:
            detail = f"cols {gcols} vs {ecols}"
        elif len(g) != len(e):
            detail = f"rows {len(g)} vs {len(e)}"
        else:
            diff = [(a, b) for a, b in zip(g, e) if a != b][:2]
            detail = f"values differ e.g. {diff}"
    return ok, len(g), t1 - t0, detail


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as se
    from sheaf.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = se.queries(), se.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            ok, n, secs, detail = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # report and go on
            ok, n, secs, detail = False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {n} rows {secs:.1f}s {detail}", flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
