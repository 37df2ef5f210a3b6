"""Read schema tables and dimension tables from files or the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from keyframe.functions.casting import apply_types
from keyframe.model import KeyModel
from keyframe.names import SCHEMA_TABLE_COLS
from keyframe.sources.storage import CSV_OPTIONS, list_names

FILE_FORMATS = ("parquet", "csv", "orc", "json")


def read_table(
    spark: SparkSession, source: str, format: str | None = None, *, rows_are_lines: bool = False
) -> DataFrame:
    """A file, folder or catalog table as a DataFrame.

    The format follows from the file suffix unless given; a name without path and
    suffix is a catalog table.  CSV files have a header and stay text: types come
    from the schema table, not from guessing.  Their cells may hold line breaks, so a file is read by one task;
    ``rows_are_lines`` promises that they do not, and a large file is split over many.
    """
    if format is None:
        suffix = source.rstrip("/").rsplit(".", 1)[-1].lower()
        format = suffix if suffix in FILE_FORMATS else "parquet" if "/" in source else "table"
    if format == "table":
        return spark.table(source)
    if format == "csv":
        return spark.read.options(**CSV_OPTIONS, multiLine=not rows_are_lines).csv(source)
    return spark.read.format(format).load(source)


def load_schema_table(spark: SparkSession, source: str, format: str | None = None) -> DataFrame:
    """The schema table: one row per column with its table, type and keys."""
    table = read_table(spark, source, format)
    missing = [c for c in SCHEMA_TABLE_COLS if c not in table.columns]
    if missing:
        raise ValueError(f"Not a schema table, it lacks the columns {missing}: {source}")
    return table.select(*SCHEMA_TABLE_COLS)


def dimension_sources(
    spark: SparkSession, folder: str, *, skip: Sequence[str] = ("README", "Schema")
) -> dict[str, str]:
    """Table name to path for every table file of a folder but the ones to skip."""
    found = {}
    for name in list_names(spark, folder):
        stem, dot, suffix = name.rpartition(".")
        table = stem if dot and suffix.lower() in FILE_FORMATS else name
        if table not in skip:
            found[table] = f"{folder.rstrip('/')}/{name}"
    return found


def load_dimensions(
    spark: SparkSession,
    sources: str | Mapping[str, str],
    model: KeyModel,
    *,
    format: str | None = None,
    rows_are_lines: bool = False,
) -> dict[str, DataFrame]:
    """Dimension tables by name, each column cast to its declared type.

    ``sources`` is a folder or a mapping from table name to path or catalog table.  ``rows_are_lines`` is as in
    :func:`read_table`.
    """
    if isinstance(sources, str):
        sources = dimension_sources(spark, sources)
    return {
        name: apply_types(read_table(spark, source, format, rows_are_lines=rows_are_lines), model.struct(name))
        for name, source in sources.items()
    }
