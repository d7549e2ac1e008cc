"""Run registered queries beside their oracles: ``python tests/compare.py [folder] [name...]``."""

from __future__ import annotations

import datetime
import decimal
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from shelfmark.session import local_session  # noqa: E402
from shelfmark.sources.shop_views import BASE_TABLES  # noqa: E402


def duck(folder: str):
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def compare(spark, connection, folder: str, build, sql: str) -> tuple[str, int, float, float]:
    started = time.time()
    frame = build(spark, folder)
    ours = rows_of(frame.columns, frame.collect())
    spent = time.time() - started
    started = time.time()
    cursor = connection.execute(sql)
    theirs = rows_of([column[0] for column in cursor.description], cursor.fetchall())
    oracle = time.time() - started
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} <> {theirs[0]}", len(ours[1]), spent, oracle
    if ours[1] == theirs[1]:
        return "", len(ours[1]), spent, oracle
    left, right = set(ours[1]), set(theirs[1])
    sample = f"rows {len(ours[1])} <> {len(theirs[1])}\n   spark {sorted(left - right, key=repr)[:3]}\n   sql   {sorted(right - left, key=repr)[:3]}"
    return sample, len(ours[1]), spent, oracle


if __name__ == "__main__":
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    session, connection = local_session(8, 8), duck(folder)
    failed = 0
    for name in chosen:
        try:
            problem, n, spent, oracle = compare(
                session, connection, folder, entry.queries()[name], entry.oracle_sql()[name]
            )
        except Exception as error:  # noqa: BLE001
            problem, n, spent, oracle = f"{type(error).__name__}: {str(error)[:1200]}", 0, 0, 0
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:24} rows={n} spark={spent:.1f}s duck={oracle:.1f}s {problem}", flush=True)
    print("failed", failed)
