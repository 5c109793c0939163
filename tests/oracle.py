"""Run a registered query and its SQL side by side: ``python tests/oracle.py [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def _cell(value) -> tuple:
    if value is None:
        return ("", "")
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, (list, tuple)):
        return ("list", repr([_cell(v) for v in value]))
    return (_kind(value), str(value))


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal, else what differs first."""
    result = con.execute(sql)
    expected = canonical([d[0] for d in result.description], result.fetchall())
    actual = canonical(df.columns, [tuple(r) for r in df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows, expected {len(expected[1])}"
    for mine, theirs in zip(actual[1], expected[1]):
        if mine != theirs:
            cells = [(n, a, b) for n, a, b in zip(actual[0], mine, theirs) if a != b]
            return f"first difference {cells}"
    return ""


def main() -> int:
    from jobsignals.lens import all_oracles, all_queries
    from jobsignals.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(all_queries())
    spark = build_session(
        "oracle", "local[8]", spark_ui_enabled="false",spark_ui_showConsoleProgress="false", spark_sql_shuffle_partitions="8", spark_driver_memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for key in keys:
        started = time.time()
        try:
            df = all_queries()[key](spark, sf_dir)
            if key in all_oracles():
                problem = compare(df, con, all_oracles()[key])
                count = f" rows: {con.execute(f'SELECT count(*) FROM ({all_oracles()[key]})').fetchone()[0]}"
            else:
                problem, count = "", f" rows only: {df.count()}"
        except Exception as exc:  # noqa: BLE001
            problem, count = f"{type(exc).__name__}: {str(exc)[:1500]}", ""
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - started:.2f}s{count} {problem}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
