"""Single-valued columns of stored tables, from the statistics in file footers where they decide."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType

from keyframe.operators.tickets import single_value_columns
from keyframe.sources.warehouse import Warehouse

# Types whose least and greatest values Parquet footers hold exactly, and from which Spark answers aggregates.
_EXACT = (IntegralType, BooleanType, DateType)


def footer_aggregate(store: Warehouse, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows, and for each column its filled cells and its least and greatest value, in one row.

    Spark takes them all from file footers (``PushedAggregation`` in the plan), so no data is read, however
    large the table.  That needs the newer Parquet reader, which is chosen in a session of its own; the
    result cannot be combined with frames of another session.
    """
    session = store.spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    schema = store[table].schema
    frame = session.read.schema(schema).parquet(store.location(table))
    each = []
    for n, c in enumerate(columns):
        col = F.col(f"`{c}`")
        each += [F.count(col).alias(f"filled_{n}"), F.min(col).alias(f"least_{n}"), F.max(col).alias(f"most_{n}")]
    return frame.agg(F.count(F.lit(1)).alias("rows"), *each)


def single_values_of_footers(store: Warehouse, table: str, columns: Sequence[str] | None = None) -> dict[str, bool]:
    """Whether columns hold exactly one distinct value (NULL counts as a value), for those that footers decide.

    Left out are partition columns, types without exact statistics, and columns that some file has no statistics of.
    """
    schema, parts = store[table].schema, store.partition_columns(table)
    names = [f.name for f in schema.fields if isinstance(f.dataType, _EXACT) and f.name not in parts]
    names = [c for c in names if columns is None or c in columns]
    if not names:
        return {}
    try:
        found = footer_aggregate(store, table, names).first()
    except (PySparkException, Py4JJavaError):
        # Some file lacks the statistics of a column, or there is no file: columns are tried one by one, and a
        # pass over the rows tells about the rest, or says what is wrong.
        each = [single_values_of_footers(store, table, [c]) for c in names] if len(names) > 1 else []
        return {c: single for known in each for c, single in known.items()}
    # Without any file there is no count either.
    rows, out = found["rows"] or 0, {}
    for n, c in enumerate(names):
        filled = found[f"filled_{n}"]
        same = filled == rows and found[f"least_{n}"] == found[f"most_{n}"]
        out[c] = rows > 0 and (same or filled == 0)
    return out


def stored_single_values(
    store: Warehouse, table: str, columns: Sequence[str] | None = None, *, probe_rows: int = 1_000
) -> list[str]:
    """The single-valued columns of a stored table, in its order: footers first, then a pass over the rest."""
    columns = [c for c in store[table].columns if columns is None or c in columns]
    known = single_values_of_footers(store, table, columns)
    rest = [c for c in columns if c not in known]
    single = single_value_columns(store[table], rest, probe_rows=probe_rows) if rest else []
    return [c for c in columns if known.get(c) or c in single]
