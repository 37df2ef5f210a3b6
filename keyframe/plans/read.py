"""Read paths: filter on readable values and versions, fetch what a ticket describes."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyframe.functions.fingerprint import DEFAULT_ALGORITHM
from keyframe.model import KeyModel
from keyframe.names import (
    COL_INDEX_COL,
    HASH_COL,
    INDEX_TABLE,
    MATNAME_COL,
    RCTYPE_TABLE,
    ROW_INDEX_COL,
    TABLE_NAME_COL,
    TASK_GROUP_COL,
    VALID_FROM_COL,
    VALID_TO_COL,
)
from keyframe.operators.constraints import require_empty
from keyframe.operators.filters import drop_task_group
from keyframe.operators.keys import Dimensions, decode_keys, encode_keys
from keyframe.operators.matrix import ENCODED_FIELDS, IndexMap, decode_matrices
from keyframe.operators.sizes import implied_range
from keyframe.operators.tickets import hash_groups, ticket_differences
from keyframe.operators.versions import filter_versions
from keyframe.sources.storage import delete_folder, stage_in
from keyframe.sources.warehouse import Warehouse


def _described(
    tables: Mapping[str, DataFrame], model: KeyModel | None, dims: Dimensions | None
) -> tuple[KeyModel, Dimensions]:
    """The model and dimensions given, or else those of the store that holds the tables."""
    if model is None or dims is None:
        if not isinstance(tables, Warehouse):
            raise ValueError("Tables that are not in a store need model= and dims=")
        model = model or tables.model()
        dims = tables.dimensions(model) if dims is None else dims
    return model, dims


def filter_table(
    tables: Mapping[str, DataFrame],
    table: str,
    *conditions: Column | str,
    model: KeyModel | None = None,
    dims: Dimensions | None = None,
    versions: str | Sequence[str] | None = None,
    matrices: bool = False,
    index_map: IndexMap | None = None,
    rctypes: DataFrame | None = None,
    tile: int | None = None,
    complete: bool = False,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
) -> DataFrame:
    """Rows of a table with readable keys that meet all conditions.

    Conditions are on readable values; Spark pushes them into the dimension scans
    and, where versions or plain columns are concerned, into the table scan.
    The tables of a store need neither ``model`` nor ``dims``.
    """
    model, dims = _described(tables, model, dims)
    rows = filter_versions(
        tables[table], versions, table, model, dims, from_col=from_col, to_col=to_col
    )
    rows = decode_keys(rows, table, model, dims)
    for condition in conditions:
        rows = rows.filter(condition)
    if matrices:
        unique = _unique_cells(table, model) and versions is None
        options = {"tile": tile, "unique_cells": unique, "complete": complete}
        rows = as_matrices(rows, tables, model, dims, index_map, rctypes, **options)
    return rows


def _unique_cells(table: str, model: KeyModel) -> bool:
    """Whether the primary key promises that no cell of a matrix comes twice."""
    key = model.primary_keys.get(table, ())
    return {MATNAME_COL, ROW_INDEX_COL, COL_INDEX_COL} <= set(key)


def as_matrices(
    rows: DataFrame,
    tables: Mapping[str, DataFrame],
    model: KeyModel,
    dims: Dimensions,
    index_map: IndexMap | None = None,
    rctypes: DataFrame | None = None,
    *,
    tile: int | None = None,
    unique_cells: bool = False,
    complete: bool = False,
) -> DataFrame:
    """Encoded matrices to one matrix column per name; other rows as they are.

    The index map is by default the index dimension, and the row and column types
    come from the stored table of them, with readable keys.
    """
    if not set(ENCODED_FIELDS) <= set(rows.columns):
        return rows
    if index_map is None:
        if INDEX_TABLE not in dims:
            raise ValueError(f"Matrices need an index map or a dimension '{INDEX_TABLE}'")
        index_map = dims[INDEX_TABLE]
    if rctypes is None:
        rctypes = decode_keys(tables[RCTYPE_TABLE], RCTYPE_TABLE, model, dims)
    options = {"tile": tile, "unique_cells": unique_cells, "complete": complete}
    return decode_matrices(rows, index_map, rctypes, **options)


def collect_ticket(
    ticket: DataFrame,
    tables: Mapping[str, DataFrame],
    *,
    model: KeyModel | None = None,
    dims: Dimensions | None = None,
    versions: str | Sequence[str] | None = None,
    decode: bool = True,
    keep_table_name: bool = False,
    set_task_group: bool = True,
    matrices: bool = True,
    index_map: IndexMap | None = None,
    rctypes: DataFrame | None = None,
    tile: int | None = None,
    verify: bool = False,
    algorithm: str = DEFAULT_ALGORITHM,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
    staged_in: list[str] | None = None,
) -> DataFrame | None:
    """The rows a ticket stands for; ``None`` for an empty ticket.

    The result is lazy and reads a small copy of the ticket in the scratch folder, which is added to
    ``staged_in``; :func:`collected_ticket` deletes it after use.

    ``verify`` hashes the rows again, with the ticket's ``algorithm``, and raises if the
    ticket no longer describes them; it applies to whole, decoded tickets, so not together with ``versions``.

    Version columns of a ticket ask for rows that are valid in all of its interval, and the rows come with
    the ticket's interval: compression may have widened the stored one since.
    The tables of a store need neither ``model`` nor ``dims``.
    """
    model, dims = _described(tables, model, dims)
    grouped = TASK_GROUP_COL in ticket.columns
    facts = ticket.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(TABLE_NAME_COL).alias("first"),
        F.max(TABLE_NAME_COL).alias("last"),
        *([F.min(TASK_GROUP_COL).alias("low"), F.max(TASK_GROUP_COL).alias("high")] if grouped else []),
    ).first()
    if facts["rows"] == 0:
        return None
    if facts["first"] != facts["last"]:
        raise ValueError("More than 1 table named in the ticket")
    table = facts["first"]
    if set_task_group and grouped and facts["low"] != facts["high"]:
        raise ValueError(f"More than 1 value of '{TASK_GROUP_COL}' in the ticket")

    wanted = encode_keys(drop_task_group(ticket).drop(TABLE_NAME_COL, HASH_COL), table, model, dims)
    rows = tables[table]
    if wanted.columns:
        # Written once: it is read for the filter and the join, and Spark learns its size.
        wanted, folder = stage_in(wanted.distinct(), "ticket")
        if staged_in is not None:
            staged_in.append(folder)
        interval = {from_col, to_col} <= set(wanted.columns)
        exact = [c for c in wanted.columns if not (interval and c in (from_col, to_col))]
        implied = implied_range(wanted.select(*[F.col(f"`{c}`") for c in exact])) if exact else None
        if implied is not None:
            rows, wanted = rows.filter(implied), wanted.filter(implied)
        renamed = wanted.toDF(*[f"__{c}" for c in wanted.columns])
        # Columns of the primary key hold no NULL.  Plain equality lets Spark prune partitions by the ticket's
        # values, and filter rows by a Bloom filter of them where neither side is small.
        never_null = model.primary_keys.get(table, ())
        pairs = [(c, F.col(f"`{c}`"), F.col(f"`__{c}`")) for c in exact]
        on = [a == b if c in never_null else a.eqNullSafe(b) for c, a, b in pairs]
        if interval:
            start, end = F.col(f"`__{from_col}`"), F.col(f"`__{to_col}`")
            on += [F.col(f"`{from_col}`") <= start, F.col(f"`{to_col}`") >= end]
            names = {from_col: start, to_col: end}
            rows = rows.join(renamed, on).select(
                *[names.get(c, F.col(f"`{c}`")).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]
            )
        else:
            rows = rows.join(renamed, on, "left_semi")
    rows = filter_versions(rows, versions, table, model, dims, from_col=from_col, to_col=to_col)
    readable = decode_keys(rows, table, model, dims)
    if verify:
        if versions is not None:
            raise ValueError("A ticket covers all versions, so it cannot be verified for some of them")
        require_empty(
            verify_ticket(ticket, readable, table, algorithm), f"Table '{table}' differs from what the ticket describes"
        )
    rows = readable if decode else rows
    if matrices:
        unique = _unique_cells(table, model) and versions is None
        rows = as_matrices(rows, tables, model, dims, index_map, rctypes, tile=tile, unique_cells=unique)
    if keep_table_name:
        rows = rows.select(F.lit(table).alias(TABLE_NAME_COL), "*")
    if set_task_group and grouped:
        rows = rows.withColumn(TASK_GROUP_COL, F.lit(facts["low"]))
    return rows


@contextmanager
def collected_ticket(ticket: DataFrame, tables: Mapping[str, DataFrame], **options) -> Iterator[DataFrame | None]:
    """:func:`collect_ticket` for use within a ``with`` block, at whose end the staged ticket is deleted."""
    folders: list[str] = []
    try:
        yield collect_ticket(ticket, tables, staged_in=folders, **options)
    finally:
        for folder in folders:
            delete_folder(ticket.sparkSession, folder)


def verify_ticket(
    ticket: DataFrame, rows: DataFrame, table: str, algorithm: str = DEFAULT_ALGORITHM
) -> DataFrame:
    """Ticket rows whose content in ``rows`` (readable keys) is not as hashed."""
    expected = drop_task_group(ticket)
    kept = [c for c in expected.columns if c not in (TABLE_NAME_COL, HASH_COL)]
    actual = hash_groups(rows, table, kept, algorithm=algorithm).select(*expected.columns)
    return ticket_differences(expected, actual)
