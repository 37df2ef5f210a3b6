"""Key constraints, as reports that are empty when the data is sound."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from keyframe.model import KeyModel
from keyframe.operators.keys import Dimensions, UnmatchedValues, present_keys, summary


# How many problems an error message shows beside their number.
SHOWN = 20


class ConstraintViolation(ValueError):
    """A write would break a primary key, foreign key or NOT NULL constraint."""


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column as (column, nulls), all counted in one pass."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, nulls bigint")
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def foreign_key_nulls(df: DataFrame, table: str, model: KeyModel) -> DataFrame:
    """NULLs in every foreign-key column of ``table``; no rows if it has none."""
    return null_counts(df, [fk.column for fk in present_keys(df, table, model)])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)


def _key_counts(df: DataFrame, table: str, model: KeyModel, readable: Mapping[str, str]) -> DataFrame:
    """Rows by foreign key: (column, parent, key, value, rows), all columns in one pass and one shuffle."""
    entries = [
        F.struct(
            F.lit(fk.column).alias("column"),
            F.lit(fk.parent).alias("parent"),
            F.lit(fk.parent_key).alias("parent_key"),
            F.col(f"`{fk.column}`").cast("string").alias("key"),
            F.col(f"`{readable.get(fk.column, fk.column)}`").cast("string").alias("value"),
        )
        for fk in present_keys(df, table, model)
    ]
    each = df.select(F.inline(F.array(*entries)))
    return each.groupBy("column", "parent", "parent_key", "key", "value").agg(F.count(F.lit(1)).alias("rows"))


def _without_parent(counts: DataFrame, keys: Sequence, dims: Dimensions) -> DataFrame:
    """Counted keys that no parent has; a NULL key never has one."""
    known = None
    for parent, parent_key in sorted({(fk.parent, fk.parent_key) for fk in keys}):
        own = dims[parent].select(
            F.lit(parent).alias("parent"),
            F.lit(parent_key).alias("parent_key"),
            F.col(f"`{parent_key}`").cast("string").alias("key"),
        )
        known = own if known is None else known.unionByName(own)
    return counts.join(known, ["parent", "parent_key", "key"], "left_anti")


def orphan_keys(df: DataFrame, table: str, model: KeyModel, dims: Dimensions) -> DataFrame:
    """Foreign keys without a parent as (column, parent, value, rows).

    NULL keys are not orphans.  Rows are counted per key before the anti join,
    so the join sees each key once however many rows hold it.
    """
    keys = present_keys(df, table, model)
    if not keys:
        return df.sparkSession.createDataFrame([], "column string, parent string, value string, rows bigint")
    counts = _key_counts(df, table, model, {}).filter(F.col("key").isNotNull())
    return _without_parent(counts, keys, dims).select("column", "parent", "value", "rows")


def require_empty(report: DataFrame, message: str) -> None:
    """Raise with the first rows of ``report`` unless it is empty."""
    rows = report.limit(SHOWN).collect()
    if rows:
        listed = "\n".join("  " + ", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in rows)
        raise ConstraintViolation(f"{message} ({report.count()} in all):\n{listed}")


def require_primary_key(df: DataFrame, table: str, key: Sequence[str]) -> None:
    """Refuse NULL and duplicate keys, both found by one count per key."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.count(F.lit(1)).alias("rows"))
    has_null = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in key])
    require_empty(
        counted.filter(has_null | (F.col("rows") > 1)), f"NULL or duplicate primary keys for table '{table}'"
    )


def key_problems(df: DataFrame, keys: Sequence[Sequence[str]], *, optional: int) -> DataFrame:
    """(key, rows) of NULL or repeated values of several keys, by their number, all found in one pass and one shuffle.

    Keys from number ``optional`` on may be NULL.
    """
    entries = [
        F.struct(
            F.lit(n).alias("key"),
            F.to_json(F.struct(*[F.col(f"`{c}`") for c in key])).alias("value"),
            reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in key]).alias("missing"),
        )
        for n, key in enumerate(keys)
    ]
    each = df.select(F.inline(F.array(*entries))).filter((F.col("key") < optional) | ~F.col("missing"))
    counted = each.groupBy("key", "value", "missing").agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("missing") | (F.col("rows") > 1)).select("key", "rows")


def foreign_key_violations(
    df: DataFrame,
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    readable: Mapping[str, str] | None = None,
    not_null: bool = True,
) -> DataFrame:
    """All rows a database would refuse for their foreign keys: (problem, column, parent, value, rows).

    ``readable`` maps an encoded column to the column holding the value it was
    encoded from; a NULL key is then an ``unmatched`` value.  Other columns are
    checked for ``null`` (if ``not_null``) and ``orphan`` keys.
    """
    readable = readable or {}
    keys = present_keys(df, table, model)
    if not keys:
        return df.sparkSession.createDataFrame(
            [], "problem string, column string, parent string, value string, rows bigint"
        )
    bad = _without_parent(_key_counts(df, table, model, readable), keys, dims)
    encoded, missing = F.col("column").isin(list(readable)), F.col("key").isNull()
    problem = F.when(encoded & missing, "unmatched").when(missing, "null").otherwise("orphan")
    if not not_null:
        bad = bad.filter(~missing | encoded)
    return bad.select(problem.alias("problem"), "column", "parent", "value", "rows")


def observe_foreign_keys(
    df: DataFrame,
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    readable: Mapping[str, str] | None = None,
    not_null: bool = True,
) -> tuple[DataFrame, Observation | None]:
    """``df`` as it is, and an observation that counts rows with a bad foreign key, by column.

    The counts are there after the first job that computes ``df`` (:meth:`Observation.get`), so a check costs
    no pass of its own; :func:`foreign_key_violations` needs to run only if one is above zero.  Columns in
    ``readable`` were encoded by a lookup, so NULL is all that can be wrong with them; the parents of others are
    looked up beside.  None without foreign keys.
    """
    readable = readable or {}
    keys = present_keys(df, table, model)
    if not keys:
        return df, None
    looked_up, counts = df, []
    for n, fk in enumerate(keys):
        column = F.col(f"`{fk.column}`")
        bad = column.isNull()
        if fk.column not in readable:
            parent = F.col(f"`{fk.parent_key}`")
            known = dims[fk.parent].select(parent.alias(f"__parent_{n}")).where(parent.isNotNull()).distinct()
            looked_up = looked_up.join(known, column == F.col(f"__parent_{n}"), "left")
            orphan = column.isNotNull() & F.col(f"__parent_{n}").isNull()
            bad = (bad | orphan) if not_null else orphan
        counts.append(F.count_if(bad).alias(fk.column))
    seen = Observation(f"foreign keys of {table}")
    return looked_up.observe(seen, *counts).select(*[F.col(f"`{c}`") for c in df.columns]), seen


def require_foreign_keys(df: DataFrame, table: str, model: KeyModel, dims: Dimensions, **options) -> None:
    """Raise unless :func:`foreign_key_violations` is empty; all kinds of problems are named."""
    report = foreign_key_violations(df, table, model, dims, **options)
    text = summary(report)
    if "  unmatched: " in text:
        raise UnmatchedValues(f"Cannot convert these entries of table '{table}' to foreign keys:\n{text}")
    if text:
        raise ConstraintViolation(f"insert or update on table '{table}' violates a foreign key:\n{text}")
