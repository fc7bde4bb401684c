"""Run registered queries against their DuckDB counterparts; also usable from the shell.

    python tests/oracle_check.py FOLDER [QUERY ...]
"""

import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, connection, folder: str, name: str):
    """(columns, rows) from Spark and from DuckDB, in comparable form."""
    df = contract.queries()[name](spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(contract.oracle_sql()[name])
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    return ours, theirs


def main(folder: str, names: list[str]) -> int:
    from studymart.session import build_session

    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8", spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-")
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    failed = []
    for name in names or sorted(contract.queries()):
        started = time.time()
        ours, theirs = compare(spark, connection, folder, name)
        same = ours == theirs
        print(f"{'ok  ' if same else 'DIFF'} {name:28s} rows={len(ours[1])} {time.time() - started:.2f}s")
        if not same:
            failed.append(name)
            print("   columns", ours[0], theirs[0])
            print("   only ours  ", sorted(set(ours[1]) - set(theirs[1]))[:3])
            print("   only theirs", sorted(set(theirs[1]) - set(ours[1]))[:3])
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
