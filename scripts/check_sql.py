"""Runs each registered query against its SQL text: python scripts/check_sql.py FOLDER [NAME ...]."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shelfspark.plans import catalog  # noqa: E402
from shelfspark.session import build_session  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def compare(name: str, df, con, sql: str) -> list[str]:
    """Differences between a result and its SQL; empty when they are equal."""
    relation = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in relation.description}
    order = sorted(kinds)
    theirs = [dict(zip(kinds, row)) for row in relation.fetchall()]
    problems = []
    if sorted(df.columns) != order:
        return [f"columns {sorted(df.columns)} / {order}"]
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[column]:
            problems.append(f"type of {column}: {kind} / {kinds[column]}")

    def plain(value):
        return 0.0 if isinstance(value, float) and value == 0 else value

    def lines(rows):
        return sorted(repr(tuple(plain(r[c]) for c in order)) for r in rows)

    ours = lines(df.collect())
    other = lines(theirs)
    if len(ours) != len(other):
        problems.append(f"rows {len(ours)} / {len(other)}")
    if ours != other:
        a, b = set(ours) - set(other), set(other) - set(ours)
        problems.append(f"values: {len(a)} / {len(b)} rows differ\n   {order}\n   {sorted(a)[:2]}\n   {sorted(b)[:2]}")
    return problems


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", 8, spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name, q in catalog.load().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.build(spark, folder)
            problems = compare(name, df, con, q.sql) if q.sql else ([] if df.count() else ["no rows"])
        except Exception as error:  # report every query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        state = "FAIL" if problems else ("ok" if q.sql else "ok (rows only)")
        print(f"{state:15}{name:40}{time.time() - start:6.1f}s", flush=True)
        for p in problems:
            print("   " + p, flush=True)
        spark.catalog.clearCache()
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
