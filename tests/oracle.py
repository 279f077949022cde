"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, int) and not isinstance(value, bool):
        return f"{float(value):.6f}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, query, sf_dir: str) -> str | None:
    df = query.run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(query.sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} of {len(got[1])} rows differ, e.g. {str(wrong[0])[:600]}" if wrong else None


if __name__ == "__main__":
    from opinionlake.registry import all_queries
    from opinionlake.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, query in all_queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if query.sql is None:
                outcome = f"rows only: {query.run(spark, sf_dir).count()}"
            else:
                outcome = difference(spark, con, query, sf_dir) or "ok"
        except Exception as error:  # noqa: BLE001 - report and go on
            outcome = f"ERROR {str(error)[:700]}"
        print(f"{name}: {outcome} [{time.time() - begun:.1f}s]", flush=True)
