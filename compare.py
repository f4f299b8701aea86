"""Runs check queries in Spark and their SQL twins in DuckDB and compares the rows.

    python compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

import checks
from flowline.session import local_session

# Spark type -> DuckDB types read as the same.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR", '"NULL"'}, "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP"},
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(checks.QUERIES)
    spark = local_session(8, "flowline-compare")
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = checks.QUERIES[name](spark, sf_dir)
            got = bag(df.columns, df.collect())
            took = time.time() - started
            if name not in checks.ORACLES:
                print(f"rows  {name:28} {sum(got.values()):8} {took:6.1f}s", flush=True)
                continue
            result = duck.sql(checks.ORACLES[name])
            types = dict(zip(result.columns, map(str, result.types)))
            want = bag(result.columns, result.fetchall())
            same = got == want and sorted(df.columns) == sorted(result.columns)
            odd = [
                f"{f.name}: {f.dataType.simpleString()} / {types.get(f.name)}"
                for f in df.schema
                if types.get(f.name) not in SAME_TYPE.get(f.dataType.simpleString(), ())
            ]
            print(f"{'ok   ' if same else 'DIFF '} {name:28} {sum(got.values()):8} {took:6.1f}s {' '.join(odd)}", flush=True)
            if not same:
                bad += 1
                print("   columns", sorted(df.columns), sorted(result.columns))
                print("   spark only", list((got - want).items())[:3], "of", sum((got - want).values()))
                print("   sql only  ", list((want - got).items())[:3], "of", sum((want - got).values()))
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"FAIL  {name:28} {type(error).__name__}: {str(error)[:900]}", flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
