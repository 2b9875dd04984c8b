"""Compare registered queries with their SQL in DuckDB.

Run as a script for a report: python tests/oracle.py [sf] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPE_NAMES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(rows, names, order):
    index = [names.index(c) for c in order]
    return sorted((tuple(r[k] for k in index) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[str, int]:
    """"" when schema and rows agree, else the first difference; and the row count."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    ours = {f.name: TYPE_NAMES.get(f.dataType.simpleString()) for f in df.schema.fields}
    got = [tuple(r) for r in df.collect()]
    if set(ours) != set(names):
        return f"columns {sorted(ours)} != {sorted(names)}", len(got)
    diff = {c: (ours[c], types[c]) for c in ours if ours[c] != types[c]}
    if diff:
        return f"types {diff}", len(got)
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}", len(got)
    order = sorted(ours)
    left, right = _rows(got, df.columns, order), _rows(expected, names, order)
    for a, b in zip(left, right):
        if repr(a) != repr(b):
            return f"{order}: {a} != {b}", len(got)
    return "", len(got)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from greenledger.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problem, rows = compare(df, con, oracle_sql()[name])
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", 0
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} rows={rows} "
              f"{time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
