"""Runs a query and its checking SQL and compares rows regardless of order."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


SPARK_KIND = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
              "double": "double", "string": "text", "date": "date", "boolean": "bool"}
DUCK_KIND = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64",
             "DOUBLE": "double", "VARCHAR": "text", "DATE": "date", "BOOLEAN": "bool"}


def _key(row):
    return [(v is not None, v.isoformat() if isinstance(v, datetime.date) else v) for v in row]


def spark_side(df):
    names = sorted(df.columns)
    types = {f.name: SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    rows = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    return {n: types[n] for n in names}, rows


def oracle_side(con, sql):
    cur = con.execute(sql)
    header = [(d[0], str(d[1])) for d in cur.description]
    order = sorted(range(len(header)), key=lambda i: header[i][0])
    rows = cur.fetchall()
    rows = sorted(
        (tuple(float(r[i]) if isinstance(r[i], decimal.Decimal) else r[i] for i in order) for r in rows),
        key=_key,
    )
    return {header[i][0]: DUCK_KIND.get(header[i][1], header[i][1]) for i in order}, rows
