"""Order-insensitive content hashes that combine map-side.

Each row is hashed, and a group's hash is the digest of its row count and of the sums
of two 60-bit slices of the row hashes.  Sums do not depend on row order, count
duplicates, and keep a few numbers per group however many rows it has: no group is ever
gathered into one list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)


def _sized(text: Column) -> Column:
    """A part of a nested cell with its length in front, so that parts cannot run into each other."""
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def cell_text(col: Column, dtype: DataType) -> Column:
    """One cell as text: ``=`` and the value, or ``~`` for NULL.

    Arrays, structs and maps are written part by part in the same way, so microseconds count,
    the session's time zone does not, and neither does the order of map entries.
    """
    if isinstance(dtype, StringType):
        # ";" ends a cell, so it and the escape character are escaped.
        text = F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit(";"), F.lit("\\;"))
    elif isinstance(dtype, (DoubleType, FloatType)):
        text = (col + F.lit(0.0).cast(dtype)).cast("string")  # -0.0 reads as 0.0
    elif isinstance(dtype, TimestampType):
        text = F.unix_micros(col).cast("string")  # not bound to a time zone
    elif isinstance(dtype, BinaryType):
        text = F.hex(col)
    elif isinstance(dtype, ArrayType):
        text = F.array_join(F.transform(col, lambda x: _sized(cell_text(x, dtype.elementType))), "")
    elif isinstance(dtype, StructType):
        # A NULL struct is NULL, not a struct of NULLs.
        parts = [_sized(cell_text(col[f.name], f.dataType)) for f in dtype.fields]
        text = F.when(col.isNotNull(), F.concat(F.lit(""), *parts))
    elif isinstance(dtype, MapType):
        # Entries have no order, so they are sorted by their texts.
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.concat(
                _sized(cell_text(e["key"], dtype.keyType)), _sized(cell_text(e["value"], dtype.valueType))
            ),
        )
        text = F.array_join(F.array_sort(entries), "")
    elif isinstance(dtype, VariantType):
        return cell_text(F.to_json(col), StringType())
    else:
        text = col.cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit("~"))


# ``xxhash64`` hashes rows without writing them as text, about ten times faster than
# the digests, and is only then written as one.  The digests can be recomputed by
# any other engine.
ALGORITHMS: dict[str, Callable[[Column], Column] | None] = {
    "xxhash64": None,
    "md5": F.md5,
    "sha1": F.sha1,
    "sha256": lambda text: F.sha2(text, 256),
    "sha512": lambda text: F.sha2(text, 512),
}
DEFAULT_ALGORITHM = "xxhash64"


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """The named cells as one text, in name order, so column order does not matter."""
    cells = [cell_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in sorted(columns)]
    return F.concat_ws(";", *cells) if cells else F.lit("")


def _plain_cell(col: Column, dtype: DataType) -> Column:
    """A cell that hashes alike wherever its value is the same."""
    if isinstance(dtype, IntegralType):
        return col.cast("bigint")
    if isinstance(dtype, (DoubleType, FloatType)):
        return col.cast("double") + F.lit(0.0)
    if isinstance(dtype, (BooleanType, StringType, DateType, TimestampType, TimestampNTZType, BinaryType)):
        return col
    return cell_text(col, dtype)


def _fast_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the cells, computed without writing them as text."""
    cells = []
    for name in sorted(columns):
        cell = F.col(f"`{name}`")
        # NULL cells are passed over by the hash, so they are told by a flag.
        cells += [_plain_cell(cell, df.schema[name].dataType), cell.isNull()]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (0, 1)]


# What is added up for each group: its rows, and two 60-bit slices of the row hashes.  60 bits are summed as
# three pieces of 20, which leaves room for 2**43 rows in a group and is several times faster than decimal sums.
ROWS_COL = "__rows"
PIECE_COLS = tuple(f"__{k}_{n}" for k in range(2) for n in range(3))
SUM_COLS = (ROWS_COL, *PIECE_COLS)


def _require_algorithm(algorithm: str) -> None:
    if algorithm not in ALGORITHMS:
        raise ValueError(f"Unknown hash algorithm '{algorithm}', use one of {', '.join(ALGORITHMS)}")


def sum_groups(
    df: DataFrame, keys: Sequence[Column], columns: Sequence[str], algorithm: str = DEFAULT_ALGORITHM
) -> DataFrame:
    """``keys`` and the sums (``SUM_COLS``) of the row hashes of the named columns, per group.

    Sums of disjoint sets of rows add up to those of all of them (:func:`add_sums`), so the
    hash of a group follows its changes without its rows.
    """
    _require_algorithm(algorithm)
    # Digests and slices are columns of their own, so that each is computed once.
    if algorithm == "xxhash64":
        slices = _fast_hashes(df, columns)
        rows = df.select(*keys, *[h.alias(f"__{k}") for k, h in enumerate(slices)])
        names = rows.columns[:-2]
    else:
        rows = df.select(*keys, ALGORITHMS[algorithm](row_text(df, columns)).alias("__digest"))
        names = rows.columns[:-1]
        slices = [F.conv(F.substring("__digest", s, 15), 16, 10).cast("bigint") for s in (1, 16)]
        rows = rows.select(
            *[F.col(f"`{n}`") for n in names], *[s.alias(f"__{k}") for k, s in enumerate(slices)]
        )
    pieces = [
        F.sum(F.shiftright(f"__{k}", 20 * n).bitwiseAND(2**20 - 1)).alias(f"__{k}_{n}") for k in range(2) for n in range(3)
    ]
    grouped = rows.groupBy(*[F.col(f"`{n}`") for n in names])
    return grouped.agg(F.count(F.lit(1)).alias(ROWS_COL), *pieces)


def add_sums(added: Sequence[DataFrame], removed: Sequence[DataFrame] = ()) -> DataFrame:
    """The sums of the rows of ``added`` frames of :func:`sum_groups` without those of ``removed`` ones.

    Groups without any row left are gone.
    """
    signed = [f.withColumns({c: F.col(c) * F.lit(sign) for c in SUM_COLS}) for sign, fs in ((1, added), (-1, removed)) for f in fs]
    union = signed[0]
    for frame in signed[1:]:
        union = union.unionByName(frame)
    names = [F.col(f"`{c}`") for c in union.columns if c not in SUM_COLS]
    total = union.groupBy(*names).agg(*[F.sum(c).alias(c) for c in SUM_COLS])
    return total.filter(F.col(ROWS_COL) != 0)


def digest_sums(
    sums: DataFrame, columns: Sequence[str], hash_col: str, algorithm: str = DEFAULT_ALGORITHM
) -> DataFrame:
    """Sums of groups as hashes: the other columns of ``sums`` and ``hash_col``.

    The column names are part of the hash: renaming a column changes the content.
    """
    _require_algorithm(algorithm)
    totals = []
    for k in range(2):
        parts = [F.col(f"__{k}_{n}").cast("decimal(20,0)") * F.lit(Decimal(2 ** (20 * n))) for n in range(3)]
        totals.append((parts[0] + parts[1] + parts[2]).cast("string"))
    text = F.concat_ws(":", F.lit(",".join(sorted(columns))), F.col(ROWS_COL).cast("string"), *totals)
    digest = ALGORITHMS[algorithm] or F.md5
    names = [F.col(f"`{c}`") for c in sums.columns if c not in SUM_COLS]
    return sums.select(*names, digest(text).alias(hash_col))


def hash_groups(
    df: DataFrame,
    keys: Sequence[Column],
    columns: Sequence[str],
    hash_col: str,
    algorithm: str = DEFAULT_ALGORITHM,
) -> DataFrame:
    """``keys`` and the content hash of the named columns, per group."""
    return digest_sums(sum_groups(df, keys, columns, algorithm), columns, hash_col, algorithm)
