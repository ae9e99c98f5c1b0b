"""Run registered queries next to their SQL counterparts and compare all rows.

``python tests/compare.py [data folder] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from wardline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[str], Counter]:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return names, types, _multiset(names, result.fetchall())


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    names = df.columns
    return names, [t for _, t in df.dtypes], _multiset(names, [tuple(r) for r in df.collect()])


def _multiset(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def main(sf_dir: str, wanted: list[str]) -> int:
    spark = local_session("8")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failures = 0
    if not wanted and set(queries) != set(oracles):
        print("without counterpart:", sorted(set(queries) ^ set(oracles)))
    for name in wanted or queries:
        started = time.time()
        names, types, rows = spark_rows(queries[name](spark, sf_dir))
        seconds = time.time() - started
        if name not in oracles:
            print(f"{name:34} no SQL  {sum(rows.values()):8} rows {seconds:6.2f}s")
            continue
        sql_names, sql_types, expected = sql_rows(sf_dir, oracles[name])
        same = sorted(names) == sorted(sql_names) and rows == expected
        failures += not same
        print(f"{name:34} {'ok' if same else 'DIFFERENT'} {sum(rows.values()):8} rows {seconds:6.2f}s", flush=True)
        paired = {n.lower(): t for n, t in zip(names, types)}
        for n, t in zip(sql_names, sql_types):
            spark_type = paired.get(n.lower(), "-")
            if not _same_type(spark_type, t):
                print(f"    type of {n}: {spark_type} / {t}")
        if not same:
            print("   ", sorted(names), sorted(sql_names))
            print("    only Spark:", list((rows - expected).items())[:3])
            print("    only SQL:  ", list((expected - rows).items())[:3])
    print("failures:", failures)
    return failures


def _same_type(spark_type: str, sql_type: str) -> bool:
    names = {"string": "VARCHAR", "int": "INTEGER"}
    return names.get(spark_type, spark_type.upper()) == sql_type.upper()


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]) != 0)
