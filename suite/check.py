"""Run queries in Spark and DuckDB side by side: python -m suite.check FOLDER [NAME ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", repr(value + 0.0))
    if isinstance(value, Decimal):
        return ("d", str(value.normalize()))
    return value


def same(spark_df, relation) -> str:
    """'' if both sides hold the same rows, else what differs."""
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    ours = Counter(tuple(plain(row[n]) for n in names) for row in spark_df.collect())
    order = [relation.columns.index(n) for n in names]
    rows = relation.fetchall()
    theirs = Counter(tuple(plain(row[i]) for i in order) for row in rows)
    if ours != theirs:
        lost, extra = list((theirs - ours).items()), list((ours - theirs).items())
        text = f"{sum(ours.values())} vs {len(rows)} rows; only here {extra[:2]}; only there {lost[:2]}"
        return text[:700]
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "int": "INTEGER"}
    there = dict(zip(relation.columns, map(str, relation.types)))
    wrong = [(n, t, there[n]) for n, t in spark_df.dtypes if types.get(t) != there[n]]
    return f"types {wrong}" if wrong else ""


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def main(folder: str, names: list[str]) -> int:
    from suite import oracle_sql, queries
    from tradewind.session import local_session

    spark, con = local_session("check"), connect(folder)
    bad = 0
    for name, fn in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracle_sql():
                what = same(df, con.sql(oracle_sql()[name]))
                n = "="
            else:
                n, what = df.count(), ""
        except Exception as error:  # report and go on with the next query
            n, what = "!", f"{type(error).__name__} {str(error)[:300]}"
        bad += bool(what)
        print(f"{'BAD ' if what else 'ok  '}{name} {n} {time.time() - start:.1f}s {what}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
