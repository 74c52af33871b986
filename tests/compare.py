"""Run a Spark query and its SQL twin and compare them row by row."""

import datetime
import math

import duckdb

from qa_analytics.plans.catalog import ALL_TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for name in ALL_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([c[0] for c in cursor.description], cursor.fetchall())
