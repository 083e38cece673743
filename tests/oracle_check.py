"""Run queries in Spark and their SQL in DuckDB and compare columns, row counts and values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb


def rows_of(pdf_rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, bool):
            return v
        if isinstance(v, decimal.Decimal):
            return float(v)
        if isinstance(v, (int, float)):
            return round(float(v), 6)
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat()
        if isinstance(v, (bytearray, bytes)):
            return bytes(v).hex()
        if isinstance(v, (list, tuple)):
            return tuple(norm(x) for x in v)
        return v if isinstance(v, str) else str(v)

    return sorted((tuple(norm(r[i]) for i in order) for r in pdf_rows), key=repr)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        src = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{src}')")
    return con


def compare(spark, con, folder, query, sql):
    df = query(spark, folder)
    got = rows_of(df.collect(), df.columns)
    rel = con.execute(sql)
    cols = [x[0] for x in rel.description]
    want = rows_of(rel.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols), (df.columns, cols)
    return got, want


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from cratework.session import build_session

    folder, *names = sys.argv[1:]
    spark = build_session("local[8]", **{"spark_sql_shuffle_partitions": "8", "spark_driver_memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name in q:
        if names and not any(name == n or name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            if name in o:
                got, want = compare(spark, con, folder, q[name], o[name])
                same = got == want
                bad += not same
                print(name, "OK" if same else "DIFF", len(got), len(want), f"{time.time() - t:.1f}s", flush=True)
                if not same:
                    a, b = set(got), set(want)
                    print("  only spark", list(a - b)[:4], "\n  only sql", list(b - a)[:4])
            else:
                print(name, "rows", q[name](spark, folder).count(), f"{time.time() - t:.1f}s", flush=True)
        except Exception as x:  # noqa: BLE001
            bad += 1
            print(name, "ERROR", str(x)[:900], flush=True)
    sys.exit(bool(bad))
