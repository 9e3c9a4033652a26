"""Run registered queries and their SQL twins side by side and compare the rows.

    python -m tests.oracle_check [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from __spark_entry__ import oracle_sql, queries
from siltstone.session import build_session


def cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return str(value)
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def connect(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def differences(spark, con, sf_dir, name) -> list[str]:
    df = queries()[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(got) != len(want):
        out.append(f"{len(got)} rows != {len(want)}")
    if not out and got != want:
        first = next((g, w) for g, w in zip(got, want) if g != w)
        out.append(f"values differ: {first}")
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problems = differences(spark, con, sf_dir, name)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not problems else problems}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
