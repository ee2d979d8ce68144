"""Compare registered queries with their SQL on a folder of parquet tables.

Usage: ``python -m areapulse.checks.compare FOLDER [NAME_PART ...]``
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, else what differs first."""
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = connection.execute(sql)
    want_columns, want = _sorted([c[0] for c in cursor.description], cursor.fetchall())
    got_columns, got = _sorted(spark_df.columns, spark_df.collect())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for mine, other in zip(got, want):
        if mine != other:
            kinds = [(type(a).__name__, type(b).__name__) for a, b in zip(mine, other)]
            return f"{mine} against {other} {kinds if mine == other else ''}"
    return None if got else "no rows on either side"


def main() -> int:
    from areapulse.checks.catalog import QUERIES, SQL
    from areapulse.session import local_session

    folder, parts = sys.argv[1], sys.argv[2:]
    spark = local_session()
    failed = 0
    for name, query in QUERIES.items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.time()
        try:
            if name in SQL:
                problem = difference(query(spark, folder), SQL[name], folder)
            else:
                problem = None if query(spark, folder).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "sql" if name in SQL else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
