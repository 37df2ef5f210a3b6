"""Insert-or-update by primary key, as joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyframe.operators.constraints import require_primary_key


@dataclass(frozen=True)
class Merge:
    """An upsert in its parts, all lazy.

    ``target`` is cut down to what may hold rows of the source, ``keys`` are the keys of the source, and
    ``fresh`` its rows in the columns of the target.
    """

    target: DataFrame
    keys: DataFrame
    fresh: DataFrame

    @property
    def kept(self) -> DataFrame:
        """Rows of the target that stay as they are."""
        return self.target.join(self.keys, self.keys.columns, "left_anti").select(*_columns(self.target))

    @property
    def replaced(self) -> DataFrame:
        """Rows of the target that the fresh ones replace."""
        return self.target.join(self.keys, self.keys.columns, "left_semi").select(*_columns(self.target))

    @property
    def rows(self) -> DataFrame:
        return self.kept.unionByName(self.fresh)


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    *,
    check_source: bool = True,
    partitions: Sequence[str] = (),
    listed_partitions: int = 5_000,
) -> DataFrame:
    """``target`` after upserting ``source`` by ``key``.

    Known keys update the columns ``source`` has, new keys are inserted with NULL
    in the columns it lacks.  Columns unknown to ``target`` and duplicate or NULL
    keys in ``source`` are errors.

    The target is only ever probed with keys of the source (anti and semi joins
    whose right side is the source), so a small source is broadcast and the
    target is not shuffled.  A source Spark knows to be large makes them shuffle
    joins on the primary key, which has no hot values.

    With ``partitions`` (partition columns of the target, part of the key) the
    result holds just the partitions in which the source has rows; up to
    ``listed_partitions`` of them are named one by one in the scan.
    """
    options = {"check_source": check_source, "partitions": partitions, "listed_partitions": listed_partitions}
    return plan_merge(target, source, key, **options).rows


def plan_merge(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    *,
    check_source: bool = True,
    partitions: Sequence[str] = (),
    listed_partitions: int = 5_000,
    replaced: DataFrame | None = None,
) -> Merge:
    """:func:`merge_rows` in its parts.  ``replaced``, if the caller has it at hand, saves a look at the target."""
    key = list(key)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"Columns {unknown} do not exist in the target table")
    absent = [c for c in key if c not in source.columns]
    if absent:
        raise ValueError(f"Primary key columns {absent} are missing from the rows to upsert")
    if check_source:
        require_primary_key(source, "rows to upsert", key)
    source = source.select(
        *[F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in source.columns]
    )
    keys = source.select(*[F.col(f"`{c}`") for c in key])
    if partitions:
        outside = [c for c in partitions if c not in key]
        if outside:
            raise ValueError(f"Partition columns {outside} are not part of the primary key {key}")
        target = _in_touched_partitions(target, keys, list(partitions), listed_partitions)
    lacking = [c for c in target.columns if c not in source.columns]
    if lacking:
        # Fill the columns the source lacks from the rows it updates; at most as
        # many of these as the source has rows.
        old = (target if replaced is None else replaced).select(*[F.col(f"`{c}`") for c in (*key, *lacking)])
        source = source.join(old if replaced is not None else old.join(keys, key, "left_semi"), key, "left")
    return Merge(target, keys, source.select(*_columns(target)))


def _in_touched_partitions(
    target: DataFrame, keys: DataFrame, partitions: list[str], most: int
) -> DataFrame:
    """Target rows in partitions the source has rows for.

    The values are listed as literals, which prunes partitions when the query is
    planned; the list is no longer than the list of partitions in the catalog.  The
    semi join makes the choice exact for combinations of several columns, and alone
    does it for very long lists.
    """
    columns = [F.col(f"`{c}`") for c in partitions]
    touched = keys.select(*columns).distinct()
    rows = touched.limit(most + 1).collect()
    if len(rows) <= most:
        for name, column in zip(partitions, columns):
            target = target.filter(column.isin(sorted({r[name] for r in rows})))
        if len(partitions) == 1:
            return target
    return target.join(touched, partitions, "left_semi").select(*target.columns)
