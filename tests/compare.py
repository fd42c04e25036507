"""Run a registered query and its SQL on the same folder and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def results(name: str, spark: SparkSession, folder: str, connection) -> tuple:
    """((columns, rows) of Spark, (columns, rows) of the SQL), in comparable order."""
    from voltscape import oracle, registry

    frame = registry.run(name, spark, folder)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    # no cross join and no Python in any plan
    for banned in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert banned not in plan, f"{banned} in the plan of {name}"
    cursor = connection.execute(oracle.sql(name))
    names = [column[0] for column in cursor.description]
    return _rows(frame.columns, frame.collect()), _rows(names, cursor.fetchall())
