"""Compare a Spark result with DuckDB's result of the equivalent SQL."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb

FOLDER = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return ("float", None if math.isnan(value) else value)
    if isinstance(value, decimal.Decimal):
        return ("number", int(value) if value == value.to_integral() else value)
    if isinstance(value, bool) or value is None:
        return (type(value).__name__, value)
    if isinstance(value, int):
        return ("number", value)
    if isinstance(value, datetime.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    return (type(value).__name__, str(value))


def normalise(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    columns = [names[i] for i in order]
    cells = sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)
    return columns, cells


def compare(spark, folder, query, sql):
    """Both sides, normalised: (spark columns, spark rows, oracle columns, oracle rows)."""
    frame = query(spark, folder)
    ours = normalise(frame.columns, frame.collect())
    result = connect(folder).execute(sql)
    theirs = normalise([d[0] for d in result.description], result.fetchall())
    return ours, theirs
