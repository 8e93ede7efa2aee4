"""Run the queries and their SQL twins side by side and compare whole results.

    python -m conformance.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

from conformance.oracles import ORACLES
from conformance.registry import QUERIES
from ratingloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when rows, column names, types and values agree."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    spark_types = {c: TYPE_NAMES.get(t, t) for c, t in df.dtypes}
    actual = ordered([tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()])
    if name not in ORACLES:
        return ""
    relation = con.execute(ORACLES[name])
    names = [column[0] for column in relation.description]
    types = {column[0]: str(column[1]) for column in relation.description}
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    if types != spark_types:
        return f"types {[(c, spark_types[c], types[c]) for c in columns if spark_types[c] != types[c]]}"
    place = [names.index(c) for c in columns]
    expected = ordered([tuple(row[i] for i in place) for row in relation.fetchall()])
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"first difference {got} != {want}"
    return "" if actual else "no rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report every query, whatever the first one does
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        seconds = time.perf_counter() - start
        print(f"{'FAIL' if problem else 'ok':4} {name:26} {seconds:6.2f}s {problem}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
