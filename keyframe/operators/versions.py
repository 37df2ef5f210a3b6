"""Version intervals: pick the rows of some versions, and merge equal rows across versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyframe.model import KeyModel
from keyframe.names import VALID_FROM_COL, VALID_TO_COL
from keyframe.operators.keys import Dimensions, UnmatchedValues, encode_column, lookup_keys


def version_ids(
    labels: Sequence[str],
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    from_col: str = VALID_FROM_COL,
) -> dict[str, int]:
    """Ids of version labels, by the parent of the table's first version column."""
    fk = model.foreign_key(table, from_col)
    try:
        return lookup_keys(labels, dims[fk.parent], key=fk.parent_key, value=fk.parent_value)
    except UnmatchedValues as error:
        raise UnmatchedValues(f"Unknown version_string: {error}") from None


def version_id(
    label: str, table: str, model: KeyModel, dims: Dimensions, *, from_col: str = VALID_FROM_COL
) -> int:
    """Id of one version label."""
    if not isinstance(label, str):
        raise ValueError("version_id() takes exactly one label")
    return version_ids([label], table, model, dims, from_col=from_col)[label]


def encode_versions(
    df: DataFrame,
    column: str,
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    from_col: str = VALID_FROM_COL,
) -> DataFrame:
    """A column of version labels to ids, as a join."""
    fk = model.foreign_key(table, from_col)
    return encode_column(df, column, dims[fk.parent], key=fk.parent_key, value=fk.parent_value)


def filter_versions(
    df: DataFrame,
    labels: str | Sequence[str] | None,
    table: str,
    model: KeyModel,
    dims: Dimensions,
    *,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
    dedupe: bool = False,
) -> DataFrame:
    """Rows valid in the requested versions.

    ``None`` asks for all versions and an empty list for none.  A row valid in
    several requested versions comes once for each of them, unless ``dedupe``.
    All versions are served by one scan: the interval bounds reach the reader as
    pushed filters, and a row's multiplicity is the number of listed ids that its interval holds.
    """
    if labels is None:
        return df
    if isinstance(labels, str):
        labels = [labels]
    if not labels:
        return df.filter(F.lit(False))
    ids = sorted(version_ids(labels, table, model, dims, from_col=from_col).values())
    start, end = F.col(f"`{from_col}`"), F.col(f"`{to_col}`")
    # For one id these two bounds are the whole condition.
    df = df.filter((start <= ids[-1]) & (end >= ids[0]))
    if len(ids) == 1:
        return df

    listed = F.lit(ids)
    if dedupe:
        return df.filter(F.exists(listed, lambda v: (start <= v) & (end >= v)))
    names = [F.col(f"`{c}`") for c in df.columns]
    within = F.explode(F.filter(listed, lambda v: (start <= v) & (end >= v))).alias("__version")
    return df.select(*names, within).drop("__version")


def compress_versions(
    df: DataFrame,
    *,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
    bridge_gaps: bool = True,
) -> DataFrame:
    """Merge rows that differ only in their version interval.

    With ``bridge_gaps`` one row spans from the first to the last version of
    equal rows, also over versions in which they were missing; this is one hash
    aggregate.  Without it, only overlapping and adjacent intervals merge.
    NULLs compare equal.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in (from_col, to_col)]
    names = [F.col(f"`{c}`") for c in df.columns]
    start, end = F.col(f"`{from_col}`"), F.col(f"`{to_col}`")
    if bridge_gaps:
        merged = df.groupBy(*others).agg(F.min(start).alias(from_col), F.max(end).alias(to_col))
        return merged.select(*names)
    # One row per starting version first: a window group then holds at most as
    # many rows as there are versions, however many copies a row has.
    starts = df.groupBy(*others, start).agg(F.max(end).alias(to_col))
    by_start = Window.partitionBy(*others).orderBy(start)
    seen = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(seen.isNull() | (start > seen + 1), 1).otherwise(0)
    island = F.sum("__opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        starts.withColumn("__opens", opens)
        .withColumn("__island", island)
        .groupBy(*others, "__island")
        .agg(F.min(start).alias(from_col), F.max(end).alias(to_col))
    )
    return merged.select(*names)


def same_but_version(
    df: DataFrame, others: DataFrame, *, from_col: str = VALID_FROM_COL, to_col: str = VALID_TO_COL
) -> DataFrame:
    """Rows of ``df`` that equal some row of ``others`` in all but the version columns; NULLs compare equal.

    Rows meet by one 64-bit fingerprint of those columns, and the columns themselves decide.
    """
    names = [c for c in df.columns if c not in (from_col, to_col)]

    def print_of(frame: DataFrame):
        # NULLs are passed over by the hash; the comparison after it tells them apart.
        return F.xxhash64(*[F.col(f"`{c}`") for c in names]) if names else F.lit(0)

    groups = others.select(*[F.col(f"`{c}`").cast(df.schema[c].dataType).alias(c) for c in names]).distinct()
    groups = groups.select(print_of(groups).alias("__print"), *[F.col(f"`{c}`").alias(f"__{c}") for c in names])
    on = [F.col("__own") == F.col("__print"), *[F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in names]]
    return df.withColumn("__own", print_of(df)).join(groups, on, "left_semi").drop("__own")
