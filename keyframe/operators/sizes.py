"""Filters that a join implies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType


def implied_range(wanted: DataFrame) -> Column | None:
    """A filter on the columns of ``wanted`` that holds for every row with a match in it.

    It is the range from least to greatest value of each column, whatever the number of rows, and made of
    literals, so it prunes partitions and row groups when the query is planned.  It holds for all rows of
    ``wanted`` too: put on both sides of a join, it makes Spark consider the exact pruning of partitions
    while the query runs, by the values that the other side turns out to have.
    """
    plain = (IntegralType, StringType, BooleanType, DateType)
    names = [f.name for f in wanted.schema.fields if isinstance(f.dataType, plain)]
    if not names:
        return None
    columns = [F.col(f"`{n}`") for n in names]
    ends = [f(c).alias(f"{n}_{k}") for n, c in enumerate(columns) for k, f in enumerate((F.min, F.max))]
    gaps = [F.count_if(c.isNull()).alias(f"{n}_null") for n, c in enumerate(columns)]
    found, combined = wanted.agg(*ends, *gaps).first(), None
    for n, column in enumerate(columns):
        test = column.between(found[f"{n}_0"], found[f"{n}_1"]) if found[f"{n}_0"] is not None else F.lit(False)
        test = test | column.isNull() if found[f"{n}_null"] else test
        combined = test if combined is None else combined & test
    return combined
