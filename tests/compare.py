"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

    python tests/compare.py [scale folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value + 0.0:.6f}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        tuple(canonical(row[i]) for i in order) for row in rows
    )


def kinds(columns, rows):
    """Python type of each column's first value, to catch int against float."""
    found = {}
    for row in rows:
        for name, value in zip(columns, row):
            if value is not None:
                found.setdefault(name, type(value).__name__)
    return found


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str | None:
    """A description of the first difference, or None."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got_kinds, want_kinds = kinds(df.columns, got), kinds(names, want)
    got_columns, got_rows = rows_of(df.columns, got)
    want_columns, want_rows = rows_of(names, want)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows != {len(want_rows)}"
    differing = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    if differing:
        g, w = differing[0]
        cells = [(c, a[:200], b[:200]) for c, a, b in zip(got_columns, g, w) if a != b]
        return f"{len(differing)} of {len(got_rows)} rows differ, e.g. {cells}"
    if got_kinds != want_kinds:
        return f"types {got_kinds} != {want_kinds}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from answerloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("OFF")
    con, found, sqls = duck(sf_dir), queries(), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or found:
        start = time.time()
        try:
            difference = compare(spark, con, sf_dir, name, found[name], sqls.get(name))
        except Exception as error:  # reported per query, the run goes on
            difference = f"error {str(error)[:600]}"
        bad += difference is not None
        kind = "oracle" if name in sqls else "rows"
        print(f"{name:22s} {kind:6s} {time.time() - start:6.1f}s {difference or 'ok'}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or found)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
