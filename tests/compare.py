"""Run queries in Spark and DuckDB and compare schema, row count and values."""

from __future__ import annotations

import datetime
import os
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from catalog.inputs import TABLES

DUCK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def duck_type(kind: T.DataType) -> str:
    name = kind.simpleString()
    return name.upper() if name.startswith("decimal") else DUCK_TYPES.get(name, name)


def plain(value):
    if isinstance(value, Decimal):
        return ("num", value.normalize() if value else Decimal(0))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; an empty list when nothing does."""
    names = sorted(df.columns)
    got = con.execute(f"select * from ({sql}) limit 0")
    types = {c[0]: str(t) for c, t in zip(got.description, [c[1] for c in got.description], strict=True)}
    found = []
    if names != sorted(types):
        return [f"columns: only Spark {set(names) - set(types)}, only SQL {set(types) - set(names)}"]
    for f in df.schema.fields:
        if duck_type(f.dataType) != types[f.name].replace(" ", ""):
            found.append(f"type of {f.name}: {duck_type(f.dataType)} and {types[f.name]}")
    listed = ", ".join(f'"{n}"' for n in names)
    ours = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    theirs = Counter(tuple(plain(v) for v in row) for row in con.execute(f"select {listed} from ({sql})").fetchall())
    if ours != theirs:
        found.append(f"rows: {sum(ours.values())} and {sum(theirs.values())}")
        for side, extra in (("Spark", ours - theirs), ("SQL", theirs - ours)):
            for row in sorted(extra, key=str)[:2]:
                found.append(f"  only {side}: {dict(zip(names, row, strict=True))}")
    return found


def main(spark: SparkSession, sf_dir: str, only: list[str]) -> int:
    from catalog.oracle import SQL
    from catalog.queries import QUERIES

    con, bad = connect(sf_dir), 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), con, SQL[name]) if name in SQL else ["no SQL"]
        except Exception as problem:  # noqa: BLE001
            found = [f"{type(problem).__name__}: {str(problem)[:400]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    return bad


if __name__ == "__main__":
    import sys

    from hearthline.session import local_session

    print("differing:", main(local_session("compare", 8), sys.argv[1], sys.argv[2:]))
