"""Tickets: group columns plus a content hash, enough to fetch the same rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, VariantType

from keyframe.functions import fingerprint
from keyframe.names import HASH_COL, TABLE_NAME_COL, USUAL_GROUP_COLS


def _comparable(dtype: DataType) -> bool:
    return not isinstance(dtype, (MapType, VariantType))


def _is_single(column: str) -> Column:
    """Aggregate: exactly one distinct value, where NULL counts as a value."""
    col = F.col(f"`{column}`")
    filled, rows = F.count(col), F.count(F.lit(1))
    return ((filled == rows) & (rows > 0) & (F.min(col) == F.max(col))) | ((filled == 0) & (rows > 0))


def single_value_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, is_single) for every column, from one pass of min, max and count."""
    columns = [c for c in (columns or df.columns) if _comparable(df.schema[c].dataType)]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, is_single boolean")
    flags = df.agg(*[F.coalesce(_is_single(c), F.lit(False)).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("is_single")) for c in columns]
    return flags.select(F.inline(F.array(*pairs)))


def single_value_columns(
    df: DataFrame, columns: Sequence[str] | None = None, *, probe_rows: int = 0
) -> list[str]:
    """Names of the columns that hold one distinct value in the whole frame.

    With ``probe_rows``, a column that differs within that many first rows is
    ruled out before the full pass, which then reads only the columns left.  That
    pays off on stored tables, where the first rows come from one small task.
    """
    columns = [c for c in (columns or df.columns) if _comparable(df.schema[c].dataType)]
    if probe_rows and columns:
        # Hashes, not values, reach the driver: different hashes mean different values.
        head = df.select(*[F.xxhash64(F.col(f"`{c}`")) for c in columns]).take(probe_rows)
        columns = [c for n, c in enumerate(columns) if len({row[n] for row in head}) == 1]
    if not columns:
        return []
    return [r["column"] for r in single_value_report(df, columns).filter("is_single").collect()]


def group_columns(
    df: DataFrame,
    *,
    usual: Sequence[str] | None = USUAL_GROUP_COLS,
    additional: Sequence[str] | None = None,
    keep_single: bool = True,
    probe_rows: int = 0,
) -> list[str]:
    """The columns a ticket keeps, in frame order."""
    if usual is None and additional is None and not keep_single:
        raise ValueError("A ticket needs usual or additional group columns, or keep_single")
    named = {*(usual or ()), *(additional or ())}
    rest = [c for c in df.columns if c not in named]
    single = single_value_columns(df, rest, probe_rows=probe_rows) if keep_single and rest else []
    kept = named.union(single)
    return [c for c in df.columns if c in kept]


def ticket(
    df: DataFrame,
    table: str,
    *,
    usual: Sequence[str] | None = USUAL_GROUP_COLS,
    additional: Sequence[str] | None = None,
    keep_single: bool = True,
    probe_rows: int = 0,
    algorithm: str = fingerprint.DEFAULT_ALGORITHM,
    table_col: str = TABLE_NAME_COL,
    hash_col: str = HASH_COL,
) -> DataFrame:
    """One row per group: table name, group columns, hash of all other columns.

    Group columns are the usual ones present in ``df``, the single-valued ones
    (which takes a pass over the data) and the additional ones.  Stored tables
    and frames give the same hash for the same rows, in any order.
    """
    if not isinstance(table, str):
        raise ValueError("ticket() takes exactly one table name")
    content = df.drop(table_col)
    kept = group_columns(
        content, usual=usual, additional=additional, keep_single=keep_single, probe_rows=probe_rows
    )
    return hash_groups(
        content, table, kept, algorithm=algorithm, table_col=table_col, hash_col=hash_col
    )


def hash_groups(
    df: DataFrame,
    table: str,
    kept: Sequence[str],
    *,
    algorithm: str = fingerprint.DEFAULT_ALGORITHM,
    table_col: str = TABLE_NAME_COL,
    hash_col: str = HASH_COL,
) -> DataFrame:
    """The ticket of ``df`` for given group columns."""
    nested = [c for c in df.columns if c not in kept]
    # Grouping by the constant name too keeps an empty frame an empty ticket.
    keys = [F.lit(table).alias(table_col), *[F.col(f"`{c}`") for c in kept]]
    return fingerprint.hash_groups(df, keys, nested, hash_col, algorithm)


def sum_rows(
    df: DataFrame, kept: Sequence[str], *, algorithm: str = fingerprint.DEFAULT_ALGORITHM
) -> DataFrame:
    """What a ticket of ``df`` hashes for given group columns, before it is hashed: additive sums per group."""
    nested = [c for c in df.columns if c not in kept]
    # Without group columns a constant makes the group, as in hash_groups: an empty frame has none.
    keys = [F.lit(True).alias("__all"), *[F.col(f"`{c}`") for c in kept]]
    return fingerprint.sum_groups(df, keys, nested, algorithm).drop("__all")


def ticket_of_sums(
    sums: DataFrame,
    table: str,
    columns: Sequence[str],
    *,
    algorithm: str = fingerprint.DEFAULT_ALGORITHM,
    table_col: str = TABLE_NAME_COL,
    hash_col: str = HASH_COL,
) -> DataFrame:
    """The ticket of a table with these ``columns`` whose groups have these sums; equal to :func:`hash_groups`."""
    kept = [c for c in sums.columns if c not in fingerprint.SUM_COLS]
    nested = [c for c in columns if c not in kept]
    hashed = fingerprint.digest_sums(sums, nested, hash_col, algorithm)
    return hashed.select(F.lit(table).alias(table_col), "*")


def ticket_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of ``expected`` that ``actual`` lacks: empty when all content is as hashed."""
    on = [expected[c].eqNullSafe(actual[c]) for c in expected.columns]
    return expected.join(actual, on, "left_anti")
