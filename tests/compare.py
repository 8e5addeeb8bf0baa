"""Compare the registered queries with their SQL on DuckDB.

    python tests/compare.py [sf dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def canonical(names, rows):
    """Columns by name, rows sorted: independent of either order."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return (
        [names[i] for i in order],
        sorted(tuple(_sortable(row[i]) for i in order) for row in rows),
    )


def spark_result(df):
    return canonical(df.columns, [tuple(row) for row in df.collect()])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return canonical([column[0] for column in cursor.description], cursor.fetchall())


def main() -> None:
    import __spark_entry__ as contract
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(contract.oracle_sql())
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name in wanted:
        begin = time.time()
        try:
            got = spark_result(contract.queries()[name](spark, sf_dir))
            took = time.time() - begin
            want = sql_result(con, contract.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001 - listed, the rest goes on
            bad += 1
            print(f"{name:24} ERROR {str(error)[:600]}", flush=True)
            continue
        same = got == want
        bad += not same
        print(f"{name:24} {'ok' if same else 'DIFF':5} {len(got[1]):7} rows {took:6.2f} s", flush=True)
        if not same:
            print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            print("   only spark", sorted(set(got[1]) - set(want[1]))[:2])
            print("   only sql  ", sorted(set(want[1]) - set(got[1]))[:2])
    print("differences:", bad)


if __name__ == "__main__":
    main()
