"""Holds registered queries against their SQL on one data folder: python -m tests.oracle [name...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return str(x.normalize())
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    return repr(x)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.sql(sql)
    want = rows_of(list(rel.columns), rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows against {len(want)}; only here {sorted(a)[:2]}; only there {sorted(b)[:2]}"
    return None


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> None:
    import __spark_entry__ as e

    from tests.conftest import session

    spark, con, q, o = session(), connect(sf_dir), e.queries(), e.oracle_sql()
    for n in names or list(o):
        t = time.time()
        try:
            bad = compare(spark, con, n, q[n], o[n], sf_dir)
        except Exception as x:  # a report of all queries
            bad = f"{type(x).__name__}: {str(x)[:700]}"
        print(n, "equal" if bad is None else f"DIFFERS {bad}", f"{time.time() - t:.1f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
