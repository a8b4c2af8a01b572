"""Compare every query with its SQL in DuckDB: ``python check.py [sf_dir] [name …]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter

import duckdb

from streamloom.catalog import ORACLES, QUERIES
from streamloom.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if query and SQL agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in ORACLES:
        return None if df.columns else "no columns"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    mine, theirs = bag(df.columns, rows), bag(columns, result.fetchall())
    if mine != theirs:
        return f"{sum(mine.values())} against {sum(theirs.values())} rows; only here {list((mine - theirs).items())[:2]}; only there {list((theirs - mine).items())[:2]}"
    types = {d[0]: str(d[1]) for d in result.description}
    return None if mine else f"both empty ({types})"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = build_session("check", 8), oracle_connection(sf_dir)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree; {sum(n in ORACLES for n in names)} with SQL")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
