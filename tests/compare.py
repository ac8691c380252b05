"""Run registered queries and their SQL equivalents side by side.

    python -m tests.compare [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date",
    "UTINYINT": "?", "HUGEINT": "?",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(df.columns) != sorted(want_cols):
        return [f"columns {sorted(df.columns)} != {sorted(want_cols)}"]
    for c, t in df.dtypes:
        want = KINDS.get(types[c], types[c])
        if t.replace("_ntz", "") != want:
            problems.append(f"type of {c}: {t} != {types[c]}")
    if len(got_rows) != len(want_rows):
        problems.append(f"rows {len(got_rows)} != {len(want_rows)}")
    a, b = bag(got_rows, df.columns), bag(want_rows, want_cols)
    if a != b:
        problems.append(f"values differ {sorted(df.columns)}\n   spark {list((a - b).items())[:3]}\n   sql   {list((b - a).items())[:3]}")
    return problems


def main(argv):
    import __spark_entry__ as e
    from wardline.session import local_session

    folder = argv[0] if argv and "/" in argv[0] else "/root/testdata/sf0.01"
    wanted = [a for a in argv if "/" not in a]
    spark = local_session("8")
    con = duck(folder)
    queries, sqls = e.queries(), e.oracle_sql()
    bad, done = [], 0
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            if name in sqls:
                problems = compare(df, con, sqls[name])
                note = "sql"
            else:
                problems, note = ([] if df.count() > 0 else ["no rows"]), "rows"
        except Exception as x:
            problems, note = [f"{type(x).__name__}: {str(x)[:1200]}"], "error"
            if "-v" in argv:
                traceback.print_exc()
        done += 1
        if problems:
            bad.append(name)
        print(f"{'FAIL' if problems else 'ok  '} {name} [{note}] {time.time() - t:.1f}s", flush=True)
        for p in problems:
            print("    ", p, flush=True)
    extra = set(sqls) - set(queries)
    print(f"{done - len(bad)}/{done} match; failing: {bad}; sql without query: {sorted(extra)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
