"""Swap readable values for integer keys and back, through dimension tables.

Every lookup is a plain left join with the dimension cut down to (key, value).
No join carries a broadcast hint: Spark broadcasts a dimension when its known
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
where adaptive execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from keyframe.model import ForeignKey, KeyModel

Dimensions = Mapping[str, DataFrame]

# How many offending values of each column an error message shows beside their number.
SHOWN = 5


class UnmatchedValues(ValueError):
    """Some values have no counterpart in their dimension."""


def _is_key(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (ByteType, ShortType, IntegerType, LongType))


def present_keys(df: DataFrame, table: str, model: KeyModel) -> list[ForeignKey]:
    return [
        model.foreign_key(table, c)
        for c in dict.fromkeys(fk.column for fk in model.foreign_keys_of(table))
        if c in df.columns
    ]


def to_encode(
    df: DataFrame, table: str, model: KeyModel, force: Collection[str] = ()
) -> list[ForeignKey]:
    """Foreign keys still holding readable values: integer columns count as encoded."""
    return [fk for fk in present_keys(df, table, model) if fk.column in force or not _is_key(df, fk.column)]


def _attach(
    df: DataFrame, dims: Dimensions, fks: Sequence[ForeignKey], *, by_key: bool
) -> tuple[DataFrame, dict[str, Column]]:
    """Left-join each parent and return the looked-up column per child column."""
    found = {}
    for n, fk in enumerate(fks):
        given, wanted = (fk.parent_key, fk.parent_value) if by_key else (fk.parent_value, fk.parent_key)
        dim = dims[fk.parent].select(
            F.col(f"`{given}`").alias(f"__given_{n}"), F.col(f"`{wanted}`").alias(f"__wanted_{n}")
        )
        df = df.join(dim, F.col(f"`{fk.column}`") == F.col(f"__given_{n}"), "left")
        found[fk.column] = F.col(f"__wanted_{n}")
    return df, found


def unmatched_values(
    df: DataFrame, table: str, model: KeyModel, dims: Dimensions, *, force: Collection[str] = ()
) -> DataFrame:
    """Values that :func:`encode_keys` cannot encode: (column, parent, value, rows).

    Each column is counted per distinct value before the anti join, so a hot
    value is one row by the time anything is joined.  NULL never matches.
    """
    reports = []
    for fk in to_encode(df, table, model, force):
        known = dims[fk.parent].select(F.col(f"`{fk.parent_value}`").alias("__known"))
        counts = df.groupBy(F.col(f"`{fk.column}`").alias("__value")).agg(F.count(F.lit(1)).alias("rows"))
        reports.append(
            counts.join(known, F.col("__value") == F.col("__known"), "left_anti").select(
                F.lit(fk.column).alias("column"),
                F.lit(fk.parent).alias("parent"),
                F.col("__value").cast("string").alias("value"),
                "rows",
            )
        )
    if not reports:
        return df.sparkSession.createDataFrame([], "column string, parent string, value string, rows bigint")
    return reduce(DataFrame.unionByName, reports)


def encode_keys(
    df: DataFrame,
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    check: str = "inline",
    force: Collection[str] = (),
) -> DataFrame:
    """Replace the values of every foreign-key column of ``table`` by parent keys.

    Absent columns are skipped, and so are integer columns, which count as
    encoded already unless named in ``force``.  Column order is kept.

    A value without a parent (NULL included) is an error.  ``check="inline"``
    raises it from inside the one pass over the data, naming the first bad
    value; ``check="listed"`` first runs a job that lists the bad values of all
    columns; ``check="none"`` lets them become NULL.
    """
    if check not in ("inline", "listed", "none"):
        raise ValueError(f"check must be 'inline', 'listed' or 'none', not '{check}'")
    fks = to_encode(df, table, model, force)
    if not fks:
        return df
    if check == "listed":
        report = unmatched_values(df, table, model, dims, force=force)
        text = summary(report.withColumn("problem", F.lit("unmatched")))
        if text:
            raise UnmatchedValues(f"Cannot convert these entries of table '{table}' to foreign keys:\n{text}")
    joined, found = _attach(df, dims, fks, by_key=False)
    if check == "inline":
        for fk in fks:
            given = F.coalesce(F.col(f"`{fk.column}`").cast("string"), F.lit("NULL"))
            problem = f"No key in '{fk.parent}.{fk.parent_key}' for column '{fk.column}' of table '{table}': '"
            joined = require_found(joined, found[fk.column], F.concat(F.lit(problem), given, F.lit("'")))
    return joined.select(*[found[c].alias(c) if c in found else F.col(f"`{c}`") for c in df.columns])


def require_found(joined: DataFrame, found: Column, problem: Column) -> DataFrame:
    """``joined`` as it is, or an error from inside the job for a row without ``found``.

    The check is a filter, so it also runs where nobody reads the column.  It is marked as
    not deterministic, because Spark would otherwise try it on a row of NULLs while planning.
    """
    missing = found.isNull() & (F.rand(0) >= 0)
    return joined.filter(F.when(missing, F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))


def summary(report: DataFrame) -> str:
    """(problem, column, parent, value, rows) as text: per problem and column how many values and rows, and some of them."""
    groups = report.groupBy("problem", "column", "parent").agg(
        F.count(F.lit(1)).alias("values"), F.sum("rows").alias("rows")
    )
    found = sorted(groups.collect(), key=lambda r: (r["problem"], r["column"], r["parent"] or ""))
    lines = []
    for r in found:
        own = report.filter((F.col("problem") == r["problem"]) & (F.col("column") == r["column"]))
        shown = [str(x["value"]) for x in own.select("value").orderBy("value").limit(SHOWN).collect()]
        lines += [f"  {r['problem']}: {r['column']}: '{v}' is not in '{r['parent']}'" for v in shown]
        lines.append(f"  {r['problem']}: {r['column']}: {r['values']} values in {r['rows']} rows")
    return "\n".join(lines)


def decode_keys(df: DataFrame, table: str, model: KeyModel, dims: Dimensions) -> DataFrame:
    """Replace foreign keys by their readable values, each in place under its own name.

    A key without a parent becomes NULL.  Absent columns are skipped.
    """
    fks = present_keys(df, table, model)
    if not fks:
        return df
    joined, found = _attach(df, dims, fks, by_key=True)
    return joined.select(
        *[found[c].alias(c) if c in found else F.col(f"`{c}`") for c in df.columns]
    )


def encode_column(
    df: DataFrame, column: str, dim: DataFrame, *, key: str, value: str, strict: bool = True
) -> DataFrame:
    """Values of one column to keys; ``strict`` makes an unknown value an error, else NULL."""
    return _swap(df, column, dim, value, key, strict, "Unknown foreign key value")


def decode_column(
    df: DataFrame, column: str, dim: DataFrame, *, key: str, value: str, strict: bool = True
) -> DataFrame:
    """Keys of one column to values; ``strict`` makes an unknown key an error, else NULL."""
    return _swap(df, column, dim, key, value, strict, "Unknown foreign key")


def _swap(
    df: DataFrame, column: str, dim: DataFrame, given: str, wanted: str, strict: bool, problem: str
) -> DataFrame:
    pairs = dim.select(F.col(f"`{given}`").alias("__given"), F.col(f"`{wanted}`").alias("__wanted"))
    joined = df.join(pairs, F.col(f"`{column}`") == F.col("__given"), "left")
    result = F.col("__wanted")
    if strict:
        text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("NULL"))
        joined = require_found(joined, result, F.concat(F.lit(f"{problem} in column '{column}': "), text))
    return joined.select(
        *[result.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    )


def lookup_keys(
    values: Sequence, dim: DataFrame, *, key: str, value: str
) -> dict:
    """Keys of a short list of values given by the caller, as ``{value: key}``.

    Unknown values raise :class:`UnmatchedValues`.  The list is filtered inside
    the dimension scan and only its own matches reach the driver.
    """
    wanted = list(dict.fromkeys(values))
    if not wanted:
        return {}
    rows = (
        dim.filter(F.col(f"`{value}`").isin(wanted))
        .select(F.col(f"`{value}`").alias("v"), F.col(f"`{key}`").alias("k"))
        .distinct()
        .limit(2 * len(wanted) + 1)
        .collect()
    )
    found = {}
    for row in rows:
        if row["v"] in found:
            raise ValueError(f"'{row['v']}' occurs more than once in column '{value}' of its dimension")
        found[row["v"]] = row["k"]
    unknown = [v for v in wanted if v not in found]
    if unknown:
        raise UnmatchedValues(f"Unknown foreign key values: {', '.join(map(str, unknown))}")
    return {v: found[v] for v in wanted}
