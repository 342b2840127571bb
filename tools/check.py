"""Run registered queries against their SQL counterparts: tools/check.py [--sf 0.01] [name prefix ...]."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def oracle_connection(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Differences between a Spark result and a SQL result as text; empty when they agree."""
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want_types = {d[0]: str(d[1]) for d in rel.description}
    want = rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(want_names):
        return [f"columns {sorted(df.columns)} against {sorted(want_names)}"]
    for n, t in df.dtypes:
        if TYPES.get(t, t) != want_types[n]:
            problems.append(f"type of {n}: {t} against {want_types[n]}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    a, b = canonical(got, df.columns), canonical(want, want_names)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff} in columns {sorted(want_names)}")
    return problems


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    from seriesml.plans.catalogue import ORACLES, QUERIES
    from seriesml.session import build_session
    spark = build_session(master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{opts.sf}"
    con = oracle_connection(folder)
    failed = []
    for name, fn in QUERIES.items():
        if opts.names and not any(name.startswith(p) for p in opts.names):
            continue
        at = time.time()
        try:
            df = fn(spark, folder)
            if name in ORACLES:
                problems = compare(df, con, ORACLES[name])
                note = "SQL"
            else:
                problems, note = ([] if df.count() else ["no rows"]), "rows"
        except Exception as e:  # noqa: BLE001
            problems, note = [f"{type(e).__name__}: {str(e)[:600]}"], "error"
        print(f"{'ok  ' if not problems else 'FAIL'} {name} [{note}] {time.time() - at:.2f}s", flush=True)
        for p in problems:
            print("     ", p)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
