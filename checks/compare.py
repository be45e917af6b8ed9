"""Run queries next to their SQL and compare every row."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.oracle import oracle_sql  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from star_marts import local_session  # noqa: E402
from star_marts.session import drop_scratch  # noqa: E402


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return "~" if value is None else str(value)


def _rows(names: list[str], rows: list) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark, db, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree on names and on every row."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    sql = oracle_sql().get(name)
    if sql is None:
        return None
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours != theirs:
        mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
        return (
            f"{len(ours)} rows vs {len(theirs)}; only here {sorted(mine)[:3]}, "
            f"only there {sorted(other)[:3]}"
        )
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    session = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    database = tables(folder)
    failed = 0
    for query in chosen:
        start = time.time()
        try:
            problem = difference(session, database, query, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{query}: {problem or 'ok'} ({time.time() - start:.2f}s)", flush=True)
        drop_scratch(session)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    sys.exit(failed > 0)
