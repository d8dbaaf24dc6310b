"""Run registered queries in Spark and their oracle SQL in DuckDB over the
same Parquet tables, and compare rows (order-insensitive, columns by name).

    python tests/oracle_compare.py [/root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larch.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str, query, sql: str):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns spark={s_cols} oracle={d_cols}", t1 - t0, t2 - t1
    if s_types != d_types:
        return False, f"types spark={s_types} oracle={d_types}", t1 - t0, t2 - t1
    if len(s_rows) != len(d_rows):
        return False, f"rows spark={len(s_rows)} oracle={len(d_rows)}", t1 - t0, t2 - t1
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff spark={x} oracle={y}", t1 - t0, t2 - t1
    return True, f"{len(s_rows)} rows", t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from larch.session import local_session

    spark = local_session(8, checkpoint_dir=tempfile.mkdtemp(prefix="larch-compare-"))
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:24s} ROWS-ONLY {n} rows", flush=True)
            continue
        ok, detail, ts, td = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        bad += not ok
        print(f"{name:24s} {'OK  ' if ok else 'FAIL'} {detail}  spark={ts:.2f}s duck={td:.2f}s",
              flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
