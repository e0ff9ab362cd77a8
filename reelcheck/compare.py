"""Run registered queries next to their DuckDB statements: ``python -m reelcheck.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from reelcheck.oracle import ORACLE
from reelcheck.registry import QUERIES
from reelspark.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    return str(x)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both engines agree in columns, rows and values."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    relation = con.execute(ORACLE[name])
    columns = [d[0] for d in relation.description]
    want = _rows(columns, relation.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        if name in ORACLE:
            try:
                found = difference(spark, con, sf_dir, name)
            except Exception as e:  # noqa: BLE001 - reported per query
                found = f"{type(e).__name__}: {str(e)[:600]}"
            rows = ""
        else:
            found, rows = None, f"rows only: {QUERIES[name](spark, sf_dir).count()}"
        bad += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {rows} {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
