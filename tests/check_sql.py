"""Run registered queries on Spark and their SQL on DuckDB and compare every value.

    python tests/check_sql.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from cellcast.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None:
            return (0, "")
        if isinstance(v, bool):
            return (1, str(v))
        if isinstance(v, (int, float)):
            if isinstance(v, float) and math.isnan(v):
                return (2, "nan")
            return (2, repr(float(v) + 0.0))
        return (3, str(v))

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir, queries, oracles):
    t0 = time.time()
    df = queries[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if name not in oracles:
        return "rows-only", len(got[1]), t1 - t0, 0.0, ""
    cur = con.execute(oracles[name])
    want = canonical([c[0] for c in cur.description], cur.fetchall())
    t2 = time.time()
    detail = ""
    if got[0] != want[0]:
        status, detail = "COLUMNS", f"{got[0]} vs {want[0]}"
    elif len(got[1]) != len(want[1]):
        status, detail = "COUNT", f"{len(got[1])} vs {len(want[1])}"
    elif got[1] != want[1]:
        bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        status, detail = "VALUES", f"{len(bad)} of {len(got[1])}: cols={got[0]}\n   spark {[c[1] for c in bad[0][0]]}\n   sql   {[c[1] for c in bad[0][1]]}"
    else:
        status = "ok"
        if not got[1]:
            detail = "EMPTY"
    return status, len(got[1]), t1 - t0, t2 - t1, detail


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("--quiet", action="store_true")
    p.add_argument("names", nargs="*")
    args = p.parse_args()
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in queries if not args.names or any(n.startswith(p) for p in args.names)]
    failed = 0
    for n in names:
        try:
            status, rows, ts, td, detail = compare(spark, con, n, sf_dir, queries, oracles)
        except Exception as e:  # noqa: BLE001 - report and go on
            lines = str(e).strip().split("\n")
            status, rows, ts, td, detail = "ERROR", 0, 0, 0, type(e).__name__ + ": " + " ".join(lines[:6])[:900]
            if not isinstance(e, duckdb.Error) and "pyspark" not in type(e).__module__:
                detail += "\n" + "".join(traceback.format_exc()[-600:])
        if status not in ("ok", "rows-only"):
            failed += 1
        if not args.quiet or status not in ("ok", "rows-only") or detail:
            print(f"{status:9} {n:44} rows={rows:<7} spark={ts:5.2f}s sql={td:5.2f}s {detail}", flush=True)
    print(f"{len(names) - failed}/{len(names)} passed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
