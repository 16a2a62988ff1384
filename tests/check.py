"""Compare registered queries with their SQL: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from presswire import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(columns, rows):  # noqa: ANN001, ANN201
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):  # noqa: ANN201
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str):  # noqa: ANN001, ANN201
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = canonical(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows"
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return False, f"rows {len(got)} != {len(want)}; only here {str(extra)[:700]}; only SQL {str(missing)[:700]}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    session = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            ok, note = compare(session, duck, sf, n)
        except Exception as problem:  # noqa: BLE001
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {n:24s} {time.time() - t0:6.1f}s {note}", flush=True)
    print("failed:", bad)
