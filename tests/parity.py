"""Compare every query with its SQL on DuckDB: ``python tests/parity.py [sf] [name ...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def compare(spark, con, fn, sql, sf_dir):
    """Number of equal rows, or a short account of the difference."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        diff = next(((g, w) for g, w in zip(got, want, strict=False) if g != w), None)
        return f"{len(got)} rows, expected {len(want)}; first difference {diff}"
    return len(got)


if __name__ == "__main__":
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry
    from eventmart import runtime

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = runtime.session(
        "parity", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("FATAL")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"{name:28s} no SQL: {fn(spark, sf_dir).count()} rows", flush=True)
                continue
            fault = compare(spark, con, fn, sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            fault = f"{type(e).__name__}: {str(e)[:600]}"
        bad += not isinstance(fault, int)
        print(f"{name:28s} {time.time() - t:6.2f}s {fault}", flush=True)
    sys.exit(bool(bad))
