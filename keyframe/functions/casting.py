"""Coerce raw cells to the declared column types.

Text that does not parse becomes NULL instead of failing the job, also under
ANSI mode, so every cast of text is a ``try_`` variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FractionalType,
    IntegerType,
    StringType,
    StructType,
)

# The type names a schema table may declare.
DECLARED_TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "text": StringType(),
    "boolean": BooleanType(),
    "double precision": DoubleType(),
    "date": DateType(),
}
# The spellings that read as true and false.
TRUE_TEXT = ("T", "TRUE", "true", "True")
FALSE_TEXT = ("F", "FALSE", "false", "False")


def spark_type(declared: str) -> DataType:
    if declared not in DECLARED_TYPES:
        raise ValueError(f"Unknown data type: '{declared}'. Known types: {', '.join(DECLARED_TYPES)}")
    return DECLARED_TYPES[declared]


def coerce(col: Column, source: DataType, target: DataType) -> Column:
    """``col`` of type ``source`` as ``target``; unparsable text gives NULL."""
    if source == target:
        return col
    text = isinstance(source, StringType)
    if isinstance(target, IntegerType):
        # By way of double, so that "3.7" and "1e3" read as 3 and 1000.
        return (_number(col) if text else col).try_cast("int")
    if isinstance(target, DoubleType):
        return _number(col) if text else col.try_cast("double")
    if isinstance(target, BooleanType):
        if text:
            return F.when(col.isin(*TRUE_TEXT), True).when(col.isin(*FALSE_TEXT), False)
        return col.try_cast("boolean")
    if isinstance(target, DateType):
        if text:
            day = F.regexp_extract(col, r"^\s*(\d{1,4}-\d{1,2}-\d{1,2})", 1)
            return F.try_to_timestamp(day, F.lit("y-M-d")).cast("date")
        return col.try_cast("date")
    if isinstance(target, StringType):
        if isinstance(source, BooleanType):
            return F.upper(col.cast("string"))
        if isinstance(source, FractionalType):
            # A whole number stored as a double reads "3", not "3.0".
            whole = (col == F.floor(col)) & (F.abs(col) < 1e15)
            return F.when(whole, col.try_cast("long").cast("string")).otherwise(col.cast("string"))
        return col.cast("string")
    return col.try_cast(target)


def _number(col: Column) -> Column:
    # Java's parser would take the suffixes of its own literals ("1.5d").
    return F.when(~col.rlike(r"[dDfF]\s*$"), col.try_cast("double"))


def apply_types(df: DataFrame, struct: StructType) -> DataFrame:
    """Cast every column of ``df`` to its declared type; undeclared columns are errors."""
    unknown = [c for c in df.columns if c not in struct.names]
    if unknown:
        raise ValueError(f"Columns without a declared type: {unknown}")
    return df.select(
        *[coerce(F.col(f"`{c}`"), df.schema[c].dataType, struct[c].dataType).alias(c) for c in df.columns]
    )


def cast_losses(df: DataFrame, struct: StructType) -> DataFrame:
    """One row: how many non-null cells of each column its declared type cannot hold."""
    return df.agg(
        *[
            F.count_if(
                F.col(f"`{c}`").isNotNull()
                & coerce(F.col(f"`{c}`"), df.schema[c].dataType, struct[c].dataType).isNull()
            ).alias(c)
            for c in df.columns
        ]
    )
