"""Rounding to significant digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# A double carries at most 17 significant decimal digits, so 17 or more change nothing.
MAX_DIGITS = 17
# The largest power of ten that a double holds exactly is 1e22.
EXACT_POWER = 22


def _exponent(col: Column, digits: int) -> Column:
    """The power of ten that scales ``col`` to ``digits`` whole digits; NULL for zero."""
    return F.lit(max(digits, 1) - 1) - F.floor(F.log10(F.abs(col)))


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(10.0), F.abs(exponent))


def _rounded(col: Column, exponent: Column, power: Column) -> Column:
    # In two steps where one power would overflow.
    scaled = (
        F.when(exponent > 300, col * 1e300 * F.pow(F.lit(10.0), exponent - 300))
        .when(exponent > 0, col * power)
        .otherwise(col / power)
    )
    text = F.concat(F.rint(scaled).cast("bigint").cast("string"), F.lit("E"), (-exponent).cast("string"))
    rounded = (
        F.when(exponent.between(0, EXACT_POWER), F.rint(col * power) / power)
        .when(exponent.between(-EXACT_POWER, -1), F.rint(col / power) * power)
        .when(exponent.isNull() | F.isnan(col) | (F.abs(col) == float("inf")), col)
        .otherwise(text.cast("double"))
    )
    return F.coalesce(rounded, col)


def signif(col: Column, digits: int = 15) -> Column:
    """Round to ``digits`` significant digits, ties to even.

    NULL, NaN, infinities and zero pass through.  Powers of ten up to 1e22 are
    exact, so scaling by them rounds correctly.  Beyond, the digits are scaled to
    a whole number and put together with their exponent as text, which the parser
    reads as the nearest double.
    """
    if digits >= MAX_DIGITS:
        return col
    exponent = _exponent(col, digits)
    return _rounded(col, exponent, _power(exponent))


def round_double_cols(df: DataFrame, digits: int = 15) -> DataFrame:
    """Apply :func:`signif` to every double column; other columns are untouched."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    if not doubles or digits >= MAX_DIGITS:
        return df
    names = [F.col(f"`{c}`") for c in df.columns]
    # Exponents and powers are columns of their own, so that each is computed once
    # per cell and the generated code stays small enough to be compiled.
    exponents = [_exponent(F.col(f"`{c}`"), digits).alias(f"__exponent_{n}") for n, c in enumerate(doubles)]
    powers = [_power(F.col(f"__exponent_{n}")).alias(f"__power_{n}") for n in range(len(doubles))]
    prepared = df.select(*names, *exponents).select("*", *powers)
    place = {c: n for n, c in enumerate(doubles)}
    return prepared.select(
        *[
            _rounded(
                F.col(f"`{c}`"), F.col(f"__exponent_{place[c]}"), F.col(f"__power_{place[c]}")
            ).alias(c)
            if c in place
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
