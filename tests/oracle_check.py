"""Compare catalog queries with their SQL on DuckDB: names, row counts, column types, values."""

from __future__ import annotations

import collections
import sys
import time
from pathlib import Path

import duckdb

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def difference(frame, connection, sql: str) -> str | None:
    """None when the results agree, otherwise what differs."""
    result = connection.execute(sql)
    theirs = {column[0]: str(column[1]) for column in result.description}
    ours = {field: TYPES.get(kind, kind) for field, kind in frame.dtypes}
    if ours != theirs:
        return f"columns {ours} / {theirs}"
    order = sorted(theirs)
    places = [list(theirs).index(name) for name in order]
    expected = collections.Counter(
        tuple(row[place] for place in places) for row in result.fetchall()
    )
    actual = collections.Counter(tuple(row) for row in frame.select(*order).collect())
    if expected == actual:
        return None
    return (
        f"rows {sum(actual.values())} / {sum(expected.values())}; "
        f"only ours {list((actual - expected).items())[:2]}; "
        f"only theirs {list((expected - actual).items())[:2]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from ledgerloom.catalog import QUERIES
    from ledgerloom.oracles import ORACLES
    from ledgerloom.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    for name in wanted:
        start = time.time()
        try:
            problem = (
                difference(QUERIES[name](spark, folder), connection, ORACLES[name])
                if name in ORACLES
                else "no SQL"
            )
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - start:6.2f}  {name:26} {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
