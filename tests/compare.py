"""Run one query on Spark and its checking SQL on DuckDB and compare the rows."""

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return db


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is None, str(type(value)), str(value)) for value in row))


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return [df.columns[i] for i in order], _sorted(df.collect(), order)


def duck_rows(db, sql):
    result = db.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], _sorted(result.fetchall(), order)


def differences(df, db, sql, limit=3):
    """Empty text if names and rows agree, else a description of the first differences."""
    names, left = spark_rows(df)
    other_names, right = duck_rows(db, sql)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}: {[r for r in left if r not in right][:limit]} / " \
               f"{[r for r in right if r not in left][:limit]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ: {wrong[:limit]} {names}" if wrong else ""
