"""Run registered queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import REGISTERED

# Types the two engines name differently.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return db


def plain(value: object) -> str:
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return repr(value)


def difference(spark: SparkSession, db, sf: str, name: str) -> str | None:
    """What differs, or None. Values must agree to the last bit."""
    frame = REGISTERED[name](spark, sf)
    columns = sorted(frame.columns)
    rows = frame.select(*[f"`{c}`" for c in columns]).collect()
    if name not in ORACLE:
        return None if rows else "no rows"
    result = db.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in result.description}
    found = result.fetchall()
    if sorted(described) != columns:
        return f"columns {columns} against {sorted(described)}"
    kinds = {c: SAME_TYPE.get(t, t) for c, t in frame.dtypes}
    types = [f"{c}: {kinds[c]} against {described[c]}" for c in columns if kinds[c] != described[c]]
    order = [list(described).index(c) for c in columns]
    mine = sorted([plain(v) for v in row] for row in rows)
    theirs = sorted([plain(row[i]) for i in order] for row in found)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first:\n  {wrong[0][0]}\n  {wrong[0][1]}"
    return f"types: {types}" if types else None


def main(args: list[str]) -> int:
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(REGISTERED)
    spark, db = session(), database(sf)
    failed = 0
    for name in names:
        begun = time.perf_counter()
        try:
            problem = difference(spark, db, sf, name)
        except Exception as error:  # a failing query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        seconds = time.perf_counter() - begun
        failed += problem is not None
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name:28s} {kind:4s} {seconds:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) != 0)
