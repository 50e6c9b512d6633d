"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value) -> str:
        if isinstance(value, float):
            if math.isnan(value):
                return "nan"
            return repr(round(value, 6))
        return repr(value)

    return [columns[i] for i in order], sorted("|".join(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, folder: str) -> tuple[str, int, float, float]:
    """('' or the difference, rows, Spark seconds, DuckDB seconds)."""
    start = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - start
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = canonical(names, result.fetchall())
    duck_seconds = time.time() - start
    got = canonical(df.columns, rows)
    problem = ""
    if got[0] != expected[0]:
        problem = f"columns {got[0]} != {expected[0]}"
    elif got[1] != expected[1]:
        mine, theirs = set(got[1]) - set(expected[1]), set(expected[1]) - set(got[1])
        problem = (
            f"{len(got[1])} rows against {len(expected[1])}; "
            f"only here {sorted(mine)[:3]}; only there {sorted(theirs)[:3]}"
        )
    return problem, len(rows), spark_seconds, duck_seconds


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as contract
    from tests.conftest import session

    folder = sys.argv[1]
    chosen = sys.argv[2:]
    spark, con = session(), connect(folder)
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        sql = contract.oracle_sql().get(name)
        try:
            if sql is None:
                print(f"{name}: rows only, {len(query(spark, folder).collect())}", flush=True)
                continue
            problem, rows, mine, theirs = compare(spark, con, query, sql, folder)
            print(f"{name}: {problem or 'ok'} rows={rows} {mine:.2f}s duck={theirs:.2f}s", flush=True)
        except Exception as error:
            print(f"{name}: ERROR {type(error).__name__} {str(error)[:900]}", flush=True)


if __name__ == "__main__":
    main()
