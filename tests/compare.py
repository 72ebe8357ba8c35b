"""Run a query and its SQL twin and compare rows, schema and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def kind(value: object) -> str:
    """One name for the types that both engines hand over; dates are compared as they print."""
    return {"bool": "bool", "int": "int", "float": "float", "Decimal": "decimal"}.get(type(value).__name__, "other")


def kinds(rows: list[tuple]) -> list[set[str]]:
    return [{kind(v) for v in column if v is not None} for column in zip(*rows)]


def differences(got: DataFrame, want: duckdb.DuckDBPyRelation) -> list[str]:
    """What differs between the rows of a query and of its SQL twin: names, number, types, values."""
    names = sorted(got.columns)
    if names != sorted(want.columns):
        return [f"columns {names} <> {sorted(want.columns)}"]
    left = [tuple(r) for r in got.select(*names).collect()]
    right = want.project(", ".join(f'"{n}"' for n in names)).fetchall()
    problems = []
    if len(left) != len(right):
        problems.append(f"rows {len(left)} <> {len(right)}")
    if kinds(left) != kinds(right):
        pairs = zip(names, kinds(left), kinds(right))
        problems.append(f"types {({n: (a, b) for n, a, b in pairs if a != b})}")
    left, right = sorted(map(repr, left)), sorted(map(repr, right))
    unlike = [(a, b) for a, b in zip(left, right) if a != b]
    if len(left) == len(right) and unlike:
        problems.append(f"values differ in {len(unlike)} rows: {unlike[0][0]} <> {unlike[0][1]}")
    return problems


def main(folder: str, names: list[str]) -> None:
    from docket.checks.oracle import ORACLE
    from docket.checks.queries import QUERIES
    from docket.session import local_session

    spark, con = local_session(), connection(folder)
    for name in names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, folder)
            if name in ORACLE:
                problems = differences(got, con.sql(ORACLE[name]))
                verdict = "ok" if not problems else f"DIFF {problems}"
            else:
                verdict = f"{got.count()} rows only"
            print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)
        except Exception as error:
            print(f"{name:28s} FAILED {type(error).__name__} {str(error)[:600]}", flush=True)
    missing = set(ORACLE) - set(QUERIES)
    if missing:
        print("SQL without a query:", sorted(missing))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
