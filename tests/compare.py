"""Compare a query with its SQL in DuckDB: columns, row count and all values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for table in TABLES.split():
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(t[i] for i in order) for t in tuples]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark, con, sf_dir: str, query, sql: str) -> tuple[int, list[str]]:
    """Row count, and what differs (nothing if equal)."""
    df = query(spark, sf_dir)
    ours = df.toArrow().to_pylist()
    mine = _rows(df.columns, [tuple(r[c] for c in df.columns) for r in ours])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = _rows(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(mine), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(mine) != len(theirs):
        return len(mine), [f"rows {len(mine)} != {len(theirs)}"]
    found = [f"{a} != {b}" for a, b in zip(mine, theirs) if a != b]
    kinds = [(type(x), type(y)) for x, y in zip(mine[0], theirs[0])] if mine else []
    found += [f"types {p} != {q}" for p, q in kinds if p is not q and type(None) not in (p, q)]
    return len(mine), found


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as contract
    from tillstream.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        if name not in sql:
            print(f"----  {name}: rows {query(spark, sf_dir).count()}, no SQL")
            continue
        try:
            rows, found = differences(spark, con, sf_dir, query, sql[name])
        except Exception as error:
            rows, found = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '}  {name}: rows {rows}, {time.time() - start:.1f} s", *found[:3], sep="\n      ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
