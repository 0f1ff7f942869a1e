"""Compare every query with its SQL: ``python tests/agreement.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(canon(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def disagreement(con, df, sql: str) -> str | None:
    """None when schema and rows are equal, else a description of the first difference."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    kinds = {c[0]: str(c[1]) for c in cur.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wrong = [f"{c}:{t}/{kinds[c]}" for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]]
    if wrong:
        return "types " + ", ".join(wrong)
    theirs = rows_of(names, cur.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {sorted(names)}\n   {bad[0][0]}\n   {bad[0][1]}"
    return None


def main() -> None:
    from merclake.plans.catalogue import QUERIES, SQL
    from merclake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in SQL:
                problem = disagreement(con, df, SQL[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # keep going: one broken query must not hide the others
            problem = "ERROR " + str(error)[:1500]
        failed += problem is not None
        note = "" if name in SQL else " (no SQL)"
        print(f"@@ {'FAIL' if problem else 'ok  '} {time.time() - started:6.2f}s {name}{note} {problem or ''}", flush=True)
    print(f"@@ {len(chosen)} queries, {failed} failed")


if __name__ == "__main__":
    main()
