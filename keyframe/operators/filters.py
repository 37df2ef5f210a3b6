"""Member and period filters, and the task-group column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyframe.names import COUNTRY_COL, TASK_GROUP_COL, YEAR_COL

ALL = "all"


def keep_values(df: DataFrame, column: str, values: Sequence | DataFrame | str) -> DataFrame:
    """Rows whose ``column`` is among ``values``; ``"all"`` keeps every row.

    A list becomes a pushed ``IN`` filter.  A one-column DataFrame is for lists
    too long for that and becomes a semi join.
    """
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(f"`{values.columns[0]}`").alias("__wanted"))
        return df.join(wanted, F.col(f"`{column}`") == F.col("__wanted"), "left_semi")
    if isinstance(values, (str, int, float)):
        values = [values]
    values = list(values)
    if values == [ALL]:
        return df
    return df.filter(F.col(f"`{column}`").isin(values))


def filter_members_periods(
    df: DataFrame,
    members: Sequence | DataFrame | str,
    periods: Sequence | DataFrame | str | int,
    *,
    member_col: str = COUNTRY_COL,
    period_col: str = YEAR_COL,
) -> DataFrame:
    """Rows of the given members and periods; ``"all"`` switches a side off."""
    return keep_values(keep_values(df, member_col, members), period_col, periods)


def drop_task_group(df: DataFrame, column: str = TASK_GROUP_COL) -> DataFrame:
    """Without the task-group column, if there is one."""
    return df.drop(column)
