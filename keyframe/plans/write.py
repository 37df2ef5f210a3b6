"""Write paths: upsert with ticket, compression in place, filtered copy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyframe.functions.fingerprint import DEFAULT_ALGORITHM
from keyframe.functions.numeric import round_double_cols
from keyframe.model import KeyModel
from keyframe.names import (
    COUNTRY_COL,
    INDEX_TABLES_BY_TYPE,
    RCTYPE_TABLE,
    TABLE_NAME_COL,
    USUAL_GROUP_COLS,
    VALID_FROM_COL,
    VALID_TO_COL,
    YEAR_COL,
)
from keyframe.operators.constraints import (
    observe_foreign_keys,
    require_empty,
    require_foreign_keys,
    require_primary_key,
)
from keyframe.operators.filters import drop_task_group, keep_values
from keyframe.operators.keys import (
    Dimensions,
    decode_keys,
    encode_column,
    encode_keys,
    lookup_keys,
    to_encode,
)
from keyframe.operators.matrix import IndexMap, encode_matrices, matrix_columns
from keyframe.operators.tickets import ticket
from keyframe.operators.upsert import Merge, merge_rows, plan_merge
from keyframe.operators.versions import compress_versions, same_but_version
from keyframe.plans.ledger import Change, keep_ledger
from keyframe.plans.statistics import stored_single_values
from keyframe.sources.storage import stage, staged
from keyframe.sources.warehouse import Warehouse

@dataclass(frozen=True)
class Written:
    """What a write gives back: the table as it is or would be, and the ticket."""

    table: DataFrame
    ticket: DataFrame


def _only_table_name(df: DataFrame) -> str:
    if TABLE_NAME_COL not in df.columns:
        raise ValueError(f"Give a table name or a '{TABLE_NAME_COL}' column")
    names = df.select(TABLE_NAME_COL).distinct().limit(2).collect()
    if len(names) != 1:
        raise ValueError(f"'{TABLE_NAME_COL}' must hold exactly 1 table name")
    return names[0][0]


def _require_not_by_version(store: Warehouse, table: str, from_col: str, to_col: str) -> None:
    # Merging versions would empty some partitions, which an overwrite leaves alone.
    if {from_col, to_col} & set(store.partition_columns(table)):
        raise ValueError(f"Table '{table}' is partitioned by version and cannot be compressed in place")


def upsert(
    store: Warehouse,
    df: DataFrame,
    table: str | None = None,
    *,
    additional: Sequence[str] | None = None,
    usual: Sequence[str] | None = USUAL_GROUP_COLS,
    keep_single: bool = True,
    algorithm: str = DEFAULT_ALGORITHM,
    in_place: bool = False,
    encode: bool = True,
    compress: bool | str = False,
    round_doubles: bool = False,
    digits: int = 15,
    index_map: IndexMap | None = None,
    rctypes: DataFrame | None = None,
    retain_zeros: bool = False,
    model: KeyModel | None = None,
    dims: Dimensions | None = None,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
    hash_rounded: bool = True,
    probe_rows: int = 1_000,
) -> Written:
    """Insert or update the rows of ``df`` in a stored table, by primary key.

    Matrices become (i, j, value) rows, by default with the index dimensions of their
    row and column types (by default those of the stored table of them), and readable keys
    become integers; doubles may be rounded.  The ticket describes the rows with readable keys,
    and as they are stored: after rounding, unless ``hash_rounded`` is False.  It does not
    change afterwards when it was taken ``in_place``.  With ``compress`` versions are group columns.  ``probe_rows`` first rows rule out columns
    that vary before the pass for single-valued columns.  Without ``in_place`` nothing is written
    and ``Written.table`` is the lazy result.  With
    ``compress`` the whole table is compressed by version after the upsert, with
    ``compress="touched"`` only the partitions the rows fall into, and with ``compress="groups"``
    only the rows that equal a new one in all but their versions: in a table that was compressed
    before, that is all there is to compress.

    In place, the rows are staged once, checked against the primary key and the
    foreign keys, and merged.  Bad foreign keys are counted while the rows are staged, so a sound
    upsert has no further job for them.  A partitioned or bucketed table is rewritten only where the
    rows fall, unless the whole table is compressed.  A ledger of the table follows.
    """
    if compress not in (False, True, "touched", "groups"):
        raise ValueError(f"compress must be True, False, 'touched' or 'groups', not {compress!r}")
    table = table or _only_table_name(df)
    if compress:
        _require_not_by_version(store, table, from_col, to_col)
    model = model or store.model()
    dims = store.dimensions(model) if dims is None else dims
    key = model.primary_key(table)
    rows = df.drop(TABLE_NAME_COL)
    if index_map is None and matrix_columns(rows):
        index_map = {kind: dims[kind] for kind in INDEX_TABLES_BY_TYPE if kind in dims}
    if index_map:
        if rctypes is None and RCTYPE_TABLE in store:
            rctypes = decode_keys(store[RCTYPE_TABLE], RCTYPE_TABLE, model, dims)
        rows = encode_matrices(rows, index_map, rctypes, retain_zeros=retain_zeros)
    if compress:
        # Compression may merge any of the intervals, so each gets ticket rows of its own, found by containment.
        additional = [*(additional or ()), *(c for c in (from_col, to_col) if c in rows.columns)]
    grouping = {
        "usual": usual,
        "additional": additional,
        "keep_single": keep_single,
        "algorithm": algorithm,
    }
    if not in_place:
        encoded = drop_task_group(rows)
        if encode:
            encoded = encode_keys(encoded, table, model, dims)
        if round_doubles:
            encoded = round_double_cols(encoded, digits)
        if compress == "groups":
            change = _in_groups(plan_merge(store[table], encoded, key), from_col, to_col)
            merged = change.kept.unionByName(change.fresh)
        else:
            merged = merge_rows(store[table], encoded, key)
            if compress:
                merged = compress_versions(merged, from_col=from_col, to_col=to_col)
        hashed = round_double_cols(rows, digits) if round_doubles and hash_rounded else rows
        return Written(merged, ticket(hashed, table, **grouping))

    # Keys and the values they stand for are staged side by side: one pass over
    # the input serves the checks, the merge and the ticket.
    readable = {fk.column: f"__{fk.column}" for fk in to_encode(rows, table, model)} if encode else {}
    both = rows.withColumns({copy: F.col(f"`{c}`") for c, copy in readable.items()})
    both = encode_keys(both, table, model, dims, check="none") if encode else both
    checks = {"readable": readable, "not_null": store.keys_not_null(table)}
    both, seen = observe_foreign_keys(both, table, model, dims, **checks)
    with staged(both, table) as both:
        rows = both.select(*[F.col(f"`{readable.get(c, c)}`").alias(c) for c in rows.columns])
        encoded = drop_task_group(both.drop(*readable.values()))
        if round_doubles:
            encoded = round_double_cols(encoded, digits)
        # Foreign keys first: an unmatched value is NULL by now, also in a primary key.
        if seen and any(seen.get.values()):
            require_foreign_keys(both, table, model, dims, **checks)
        require_primary_key(encoded, table, key)
        _merge_into(store, table, encoded, key, compress, from_col, to_col)
        hashed = round_double_cols(rows, digits) if round_doubles and hash_rounded else rows
        # The ticket is small and is written once; the staged rows go.
        receipt = stage(ticket(hashed, table, probe_rows=probe_rows, **grouping), "ticket")
    return Written(store[table], receipt)


def _in_groups(merge: Merge, from_col: str, to_col: str) -> Merge:
    """The merge with its fresh rows compressed together with the rows of their groups, which are replaced too."""
    near = same_but_version(merge.kept, merge.fresh, from_col=from_col, to_col=to_col)
    both = compress_versions(near.unionByName(merge.fresh), from_col=from_col, to_col=to_col)
    gone = merge.keys.unionByName(near.select(*merge.keys.columns))
    return Merge(merge.target, gone, both)


def _merge_into(
    store: Warehouse,
    table: str,
    rows: DataFrame,
    key: Sequence[str],
    compress: bool | str,
    from_col: str,
    to_col: str,
) -> None:
    """Write an upsert of sound rows, as little of the table as it touches."""
    change, whole = Change(store, table), compress is True
    parts = () if whole else store.partition_columns(table)
    buckets = 0 if compress in (True, "touched") else store.buckets(table)
    merge = plan_merge(store[table], rows, key, check_source=False, partitions=parts)
    if not compress and not buckets and not change:
        return store.replace(table, merge.rows)
    if compress in (True, "touched"):
        merged = compress_versions(merge.rows, from_col=from_col, to_col=to_col)
        store.replace(table, merged)
        if change:
            # All or whole partitions were written anew anyway.
            keep_ledger(store, table, usual=None, additional=change.note["kept"], algorithm=change.note["algorithm"])
        return None
    if compress == "groups":
        merge = _in_groups(merge, from_col, to_col)
    elif buckets:
        merge = plan_merge(store.in_buckets(table, store.bucket_ids(table, merge.keys)), rows, key, check_source=False)
    # What goes and what comes is written down first: the ledger, the buckets and the merge all need it.
    with staged(merge.replaced, f"{table}-replaced") as replaced:
        if compress != "groups":
            merge = plan_merge(merge.target, rows, key, check_source=False, replaced=replaced)
        with staged(merge.fresh, f"{table}-fresh") as fresh:
            columns = [F.col(f"`{c}`") for c in key]
            gone = replaced.select(*columns).unionByName(fresh.select(*columns)).distinct()
            change.prepare(fresh, replaced)
            if buckets:
                ids = store.bucket_ids(table, gone)
                done = Merge(store.in_buckets(table, ids), gone, fresh)
                store.replace_buckets(table, done.rows, ids)
            else:
                store.replace(table, Merge(merge.target, gone, fresh).rows)
            change.commit()
    return None


def compress_table(
    store: Warehouse,
    table: str,
    *,
    from_col: str = VALID_FROM_COL,
    to_col: str = VALID_TO_COL,
    bridge_gaps: bool = True,
) -> None:
    """Merge equal rows of a stored table across versions."""
    _require_not_by_version(store, table, from_col, to_col)
    change = Change(store, table)
    merged = compress_versions(store[table], from_col=from_col, to_col=to_col, bridge_gaps=bridge_gaps)
    store.replace(table, merged)
    if change:
        keep_ledger(store, table, usual=None, additional=change.note["kept"], algorithm=change.note["algorithm"])


def filter_copy(
    store: Warehouse,
    source: str,
    dest: str,
    *,
    members: Sequence | DataFrame | None = None,
    periods: Sequence | DataFrame | None = None,
    empty_dest: bool = True,
    in_place: bool = False,
    additional: Sequence[str] | None = None,
    usual: Sequence[str] | None = USUAL_GROUP_COLS,
    keep_single: bool = True,
    algorithm: str = DEFAULT_ALGORITHM,
    model: KeyModel | None = None,
    dims: Dimensions | None = None,
    member_col: str = COUNTRY_COL,
    period_col: str = YEAR_COL,
    probe_rows: int = 1_000,
) -> Written:
    """Copy the rows of some members and periods from one table into another.

    Members and periods are readable values; an unknown one is an error and
    ``None`` means all.  The ticket covers all of ``dest`` as it is after the copy, with readable
    keys; taken ``in_place`` it does not change afterwards.  Without ``in_place`` nothing is written.
    """
    if source == dest:
        raise ValueError("source and dest must be two tables")
    model = model or store.model()
    dims = store.dimensions(model) if dims is None else dims
    rows = store[source]
    for column, wanted in ((member_col, members), (period_col, periods)):
        if wanted is None:
            continue
        fk = model.foreign_key(source, column)
        dim = dims[fk.parent]
        if isinstance(wanted, DataFrame):
            first = wanted.select(F.col(f"`{wanted.columns[0]}`").alias("wanted")).distinct()
            keys = encode_column(first, "wanted", dim, key=fk.parent_key, value=fk.parent_value)
            rows = keep_values(rows, column, keys)
        else:
            keys = lookup_keys(wanted, dim, key=fk.parent_key, value=fk.parent_value)
            rows = keep_values(rows, column, list(keys.values()))
    columns = [F.col(f"`{c}`") for c in store[dest].columns]
    rows = rows.select(*columns)
    if not in_place:
        result = rows if empty_dest else store[dest].unionByName(rows)
    else:
        change = Change(store, dest)
        aligned = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in store[dest].schema.fields])
        change.prepare(aligned, whole=empty_dest)
        if empty_dest:
            store.refill(dest, rows)
        else:
            if model.primary_keys.get(dest):
                key = list(model.primary_key(dest))
                taken = store[dest].select(*key)
                require_empty(rows.select(*key).join(taken, key, "left_semi"), f"Keys already in '{dest}'")
            store.append(dest, rows)
        change.commit()
        result = store[dest]
    if in_place and keep_single:
        # A stored table tells most of its single-valued columns without being read.
        named = {*(usual or ()), *(additional or ())}
        rest = [c for c in result.columns if c not in named]
        additional = [*(additional or ()), *stored_single_values(store, dest, rest, probe_rows=probe_rows)]
        keep_single = False
    receipt = ticket(
        result, dest, usual=usual, additional=additional, keep_single=keep_single, algorithm=algorithm
    )
    receipt = decode_keys(receipt, dest, model, dims)
    return Written(result, stage(receipt, "ticket") if in_place else receipt)
