"""Matrix columns to (i, j, value) rows and back.

A matrix cell value is an array of ``struct<rowname, colname, value>``, either one
column per matrix name (wide) or one ``matval`` column beside ``matname`` (tidy).
Row and column types, which choose the index map, come from ``rowtype`` and
``coltype`` columns or from a ``(matname, rowtype, coltype)`` frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType, StringType, StructType

from keyframe.names import (
    COL_INDEX_COL,
    COLNAME_COL,
    COLTYPE_COL,
    MATNAME_COL,
    MATVAL_COL,
    ROW_INDEX_COL,
    ROWNAME_COL,
    ROWTYPE_COL,
    VALUE_COL,
)
from keyframe.operators.keys import require_found

IndexMap = DataFrame | Mapping[str, DataFrame] | Sequence[DataFrame]

CELL_FIELDS = (ROWNAME_COL, COLNAME_COL, VALUE_COL)
ENCODED_FIELDS = (MATNAME_COL, ROW_INDEX_COL, COL_INDEX_COL, VALUE_COL)


def matrix_columns(df: DataFrame) -> list[str]:
    """Columns that hold matrices, told by their type."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, ArrayType)
        and isinstance(f.dataType.elementType, StructType)
        and set(CELL_FIELDS) <= set(f.dataType.elementType.names)
    ]


def index_frame(index_map: IndexMap, side: str) -> tuple[DataFrame, bool]:
    """The index map of one side (``"row"`` or ``"col"``) as (dimtype, idx, name).

    Accepts a mapping from row/column type to frame, a (row, column) pair of
    frames, one frame for every type, or an already long frame.  Frames have one
    integer and one text column.  Also tells whether ``dimtype`` is meaningful.
    """
    if isinstance(index_map, DataFrame):
        if set(index_map.columns) >= {"dimtype", "idx", "name"}:
            return index_map.select("dimtype", "idx", "name"), True
        return _index_columns(index_map), False
    if isinstance(index_map, Mapping):
        parts = [
            _index_columns(frame).select(F.lit(kind).alias("dimtype"), "idx", "name")
            for kind, frame in index_map.items()
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole, True
    rows, cols = index_map
    return _index_columns(rows if side == "row" else cols), False


def _index_columns(frame: DataFrame) -> DataFrame:
    ids = [f.name for f in frame.schema.fields if isinstance(f.dataType, IntegralType)]
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, StringType)]
    if len(ids) != 1 or len(names) != 1:
        raise ValueError(f"An index map needs one integer and one text column, got {frame.columns}")
    return frame.select(F.col(f"`{ids[0]}`").alias("idx"), F.col(f"`{names[0]}`").alias("name"))


def unroll(df: DataFrame) -> DataFrame:
    """Matrix columns to one row per cell: (others, matname, rowname, colname, value).

    NULL and empty matrices give no rows.  Frames without matrix columns are
    returned as they are.
    """
    columns = matrix_columns(df)
    if not columns:
        return df
    if MATVAL_COL not in df.columns:
        others = [c for c in df.columns if c not in columns]
        df = df.unpivot(others, columns, MATNAME_COL, MATVAL_COL)
    elif MATNAME_COL not in df.columns:
        raise ValueError(f"Matrix name column '{MATNAME_COL}' is missing beside '{MATVAL_COL}'")
    others = [F.col(f"`{c}`") for c in df.columns if c != MATVAL_COL]
    cell = F.col("__cell")
    return df.select(*others, F.explode(MATVAL_COL).alias("__cell")).select(
        *others, *[cell[f].alias(f) for f in CELL_FIELDS]
    )


def _with_types(df: DataFrame, rctypes: DataFrame | None, needed: bool) -> DataFrame:
    if not needed or {ROWTYPE_COL, COLTYPE_COL} <= set(df.columns):
        return df
    if rctypes is None:
        raise ValueError("Row and column types are needed to choose the index map: pass rctypes")
    kinds = rctypes.select(F.col(MATNAME_COL).alias("__matname"), F.col(ROWTYPE_COL), F.col(COLTYPE_COL))
    return df.join(kinds, F.col(MATNAME_COL) == F.col("__matname"), "left").drop("__matname")


def _look_up(
    df: DataFrame, index_map: IndexMap, side: str, given: str, given_field: str, out_field: str, out: str, what: str
) -> DataFrame:
    """``df`` with a column looked up in the index map; a row without a match is an error, whoever reads the column."""
    index, typed = index_frame(index_map, side)
    index = index.select(
        F.col(given_field).alias("__given"),
        F.col(out_field).alias(out),
        *([F.col("dimtype").alias("__dimtype")] if typed else []),
    )
    on = [F.col(f"`{given}`") == F.col("__given")]
    if typed:
        on.append(F.col(ROWTYPE_COL if side == "row" else COLTYPE_COL) == F.col("__dimtype"))
    text = F.coalesce(F.col(f"`{given}`").cast("string"), F.lit("NULL"))
    joined = df.join(index, on, "left")
    problem = F.concat(F.lit(f"No {what} for '"), text, F.lit("'"))
    return require_found(joined, F.col(out), problem).drop("__given", "__dimtype")


def encode_matrices(
    df: DataFrame,
    index_map: IndexMap,
    rctypes: DataFrame | None = None,
    *,
    retain_zeros: bool = False,
) -> DataFrame:
    """Matrices to rows (others, matname, i, j, value).

    Takes wide or tidy matrix columns, or rows per cell with ``rowname`` and
    ``colname``.  Any other frame is returned as it is.  Zero cells are dropped
    unless ``retain_zeros``.  A name missing from its index map is an error.
    """
    cells = unroll(df)
    if not {MATNAME_COL, *CELL_FIELDS} <= set(cells.columns):
        return df
    if not retain_zeros:
        # NULL is not zero and stays.
        cells = cells.filter(~F.col(VALUE_COL).eqNullSafe(0))
    typed = index_frame(index_map, "row")[1]
    cells = _with_types(cells, rctypes, typed)
    cells = _look_up(cells, index_map, "row", ROWNAME_COL, "name", "idx", "__i", "row index")
    cells = _look_up(cells, index_map, "col", COLNAME_COL, "name", "idx", "__j", "column index")
    unrolled = (*CELL_FIELDS, MATNAME_COL, ROWTYPE_COL, COLTYPE_COL, "__i", "__j")
    return cells.select(
        *[F.col(f"`{c}`") for c in cells.columns if c not in unrolled],
        F.col(MATNAME_COL),
        F.col("__i").cast("int").alias(ROW_INDEX_COL),
        F.col("__j").cast("int").alias(COL_INDEX_COL),
        F.col(VALUE_COL),
    )


def name_cells(
    encoded: DataFrame,
    index_map: IndexMap,
    rctypes: DataFrame | None = None,
    *,
    keep_index: bool = False,
    keep_types: bool = False,
) -> DataFrame:
    """Indices to names, one row per cell: (others, matname, rowname, colname, value).

    Only lookups, no grouping: the form to use for further work at scale.
    """
    typed = index_frame(index_map, "row")[1]
    cells = _with_types(encoded, rctypes, typed or keep_types)
    cells = _look_up(cells, index_map, "row", ROW_INDEX_COL, "idx", "name", "__rowname", "row name")
    cells = _look_up(cells, index_map, "col", COL_INDEX_COL, "idx", "name", "__colname", "column name")
    others = [c for c in encoded.columns if c not in (*ENCODED_FIELDS, ROWTYPE_COL, COLTYPE_COL)]
    return cells.select(
        *[F.col(f"`{c}`") for c in others],
        F.col(MATNAME_COL),
        *([F.col(ROWTYPE_COL), F.col(COLTYPE_COL)] if keep_types else []),
        *([F.col(ROW_INDEX_COL), F.col(COL_INDEX_COL)] if keep_index else []),
        F.col("__rowname").alias(ROWNAME_COL),
        F.col("__colname").alias(COLNAME_COL),
        F.col(VALUE_COL),
    )


def complete_cells(encoded: DataFrame, index_map: IndexMap, rctypes: DataFrame) -> DataFrame:
    """Encoded matrices in full: a zero for every cell of their row and column names that they lack.

    All names of a matrix's row and column type count, so the result is as large as the full matrices are.
    """
    others = [c for c in encoded.columns if c not in (*ENCODED_FIELDS, ROWTYPE_COL, COLTYPE_COL)]
    matrices = encoded.select(*[F.col(f"`{c}`") for c in (*others, MATNAME_COL)]).distinct()
    typed = index_frame(index_map, "row")[1]
    kinds = rctypes.select(*[F.col(c).alias(f"__{c}") for c in (MATNAME_COL, ROWTYPE_COL, COLTYPE_COL)])
    cells = matrices.join(kinds, F.col(MATNAME_COL) == F.col(f"__{MATNAME_COL}"))
    for side, kind, out in (("row", ROWTYPE_COL, ROW_INDEX_COL), ("col", COLTYPE_COL, COL_INDEX_COL)):
        frame = index_frame(index_map, side)[0]
        # The indices of one kind as one list, so that all cells of a matrix come from one row.
        listed = frame.groupBy(*(["dimtype"] if typed else [])).agg(F.array_sort(F.collect_list("idx")).alias(f"__{side}"))
        if typed:
            cells = cells.join(listed, F.col(f"__{kind}") == F.col("dimtype")).drop("dimtype")
        else:
            cells = cells.withColumn(f"__{side}", listed.scalar())
        cells = cells.withColumn(f"__{out}", F.explode(F.col(f"__{side}").cast("array<int>")))
    names = {ROW_INDEX_COL: f"__{ROW_INDEX_COL}", COL_INDEX_COL: f"__{COL_INDEX_COL}"}
    zero = F.lit(0).cast(encoded.schema[VALUE_COL].dataType).alias(VALUE_COL)
    kept = [F.col(f"`{c}`") for c in (*others, MATNAME_COL)]
    zeros = cells.select(*kept, *[F.col(v).alias(k) for k, v in names.items()], zero)
    have = encoded.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in zeros.columns if c != VALUE_COL])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in zeros.columns if c != VALUE_COL]
    return encoded.select(*[F.col(f"`{c}`") for c in zeros.columns]).unionByName(zeros.join(have, same, "left_anti"))


def decode_matrices(
    encoded: DataFrame,
    index_map: IndexMap,
    rctypes: DataFrame,
    *,
    wide: bool = True,
    tile: int | None = None,
    unique_cells: bool = False,
    names: Sequence[str] | None = None,
    keep_types: bool = False,
    complete: bool = False,
) -> DataFrame:
    """Rows (others, matname, i, j, value) to matrix columns.

    Wide output has one matrix column per name in ``names`` (by default all those listed in
    ``rctypes``), tidy output ``matname`` and ``matval``, with ``keep_types`` also ``rowtype`` and
    ``coltype``, so that it can be encoded again as it is.  A matrix lists its cells sorted by name; an
    absent one is NULL.  Frames without the encoded columns are returned as they are.

    A matrix is one array, whatever its size, unless ``tile`` is given: then it comes in
    tiles of that side length, rows told apart by ``tile_i`` and ``tile_j``, also where one tile is enough.  For very
    large matrices :func:`name_cells` is the form without any grouping.
    With ``complete`` a matrix has every cell of its row and column names (:func:`complete_cells`), so
    one whose zeros were not stored comes back in full shape.
    Cells given more than once are added up, as sparse matrices do, before
    anything is gathered; ``unique_cells=True`` promises there are none (a primary
    key on group, name and indices) and saves that shuffle.
    """
    if not set(ENCODED_FIELDS) <= set(encoded.columns):
        return encoded
    others = [
        c for c in encoded.columns if c not in (*ENCODED_FIELDS, ROWTYPE_COL, COLTYPE_COL)
    ]
    if not unique_cells:
        keys = [c for c in encoded.columns if c != VALUE_COL]
        encoded = encoded.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(
            F.sum(VALUE_COL).alias(VALUE_COL)
        )
    if complete:
        encoded = complete_cells(encoded, index_map, rctypes)
    cells = name_cells(encoded, index_map, rctypes, keep_index=True, keep_types=keep_types and not wide)
    groups = [F.col(f"`{c}`") for c in others]
    keys = list(others)
    if tile is not None:
        groups.append(F.floor((F.col(ROW_INDEX_COL) - 1) / tile).alias("tile_i"))
        groups.append(F.floor((F.col(COL_INDEX_COL) - 1) / tile).alias("tile_j"))
        keys += ["tile_i", "tile_j"]
    matrix = F.array_sort(F.collect_list(F.struct(*CELL_FIELDS)))
    if not wide:
        kinds = [c for c in (ROWTYPE_COL, COLTYPE_COL) if c in cells.columns]
        return cells.groupBy(*groups, F.col(MATNAME_COL), *kinds).agg(matrix.alias(MATVAL_COL))
    # The names are one row per kind of matrix; giving them to pivot saves a job
    # over the data.  A name outside of them must not get lost.
    names = list(names) if names is not None else sorted(r[0] for r in rctypes.select(MATNAME_COL).distinct().collect())
    unknown = F.concat(F.lit("No row and column types for matrix '"), F.col(MATNAME_COL), F.lit("'"))
    known = F.when(F.col(MATNAME_COL).isin(names), F.col(MATNAME_COL)).otherwise(F.raise_error(unknown))
    gathered = cells.withColumn(MATNAME_COL, known).groupBy(*groups).pivot(MATNAME_COL, names).agg(matrix)
    return gathered.select(
        *[F.col(f"`{c}`") for c in keys],
        *[F.when(F.size(F.col(f"`{n}`")) > 0, F.col(f"`{n}`")).alias(n) for n in names],
    )
