"""Runs registered queries next to their SQL on DuckDB and compares the rows.

    python tests/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        value = value.replace(tzinfo=None)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
               "date": "DATE"}


def compare(spark, con, sf_dir, run, sql):
    """None when equal, else what differs."""
    got_df = run(spark, sf_dir)
    got_cols, got = rows_of(got_df.columns, [tuple(r) for r in got_df.collect()])
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}", len(got)
    types = {f.name: (SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()),
                      want_types[f.name]) for f in got_df.schema}
    types = {k: v for k, v in types.items() if v[0] != v[1]}
    if types:
        return f"types {types}", len(got)
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return (f"{len(got)} rows vs {len(want)}; only spark: "
                f"{str(extra)[:600]}; only sql: {str(missing)[:600]}"), len(got)
    return None, len(got)


def main() -> int:
    from conftest import make_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, run, oracles.get(name))
        except Exception as e:  # report and go on
            problem, n = f"{type(e).__name__}: {str(e)[:900]}", -1
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:22s} {n:7d} rows "
              f"{time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad, "without sql:", sorted(set(queries) - set(oracles)),
          "sql only:", sorted(set(oracles) - set(queries)))
    return bad


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    sys.exit(min(main(), 1))
