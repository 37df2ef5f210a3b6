"""Immutable named snapshots: ``<root>/<name>/version=<id>/``."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from keyframe.sources.storage import CSV_OPTIONS, exists, list_names, write_text

FORMATS = ("parquet", "csv")
# How a CSV snapshot tells NULL from an empty text.
CSV_NULL = "\\N"
# How a CSV snapshot writes backslashes and line breaks, so that a row is a line and a file can be read by many tasks.
_ESCAPES = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}
# Lies in the folder of a version that was written so.
_ESCAPED = "_rows_are_lines"
NOT_RELEASED = "Release not requested."


_STAMP = "%Y%m%dT%H%M%SZ"


def _new_version(earlier: list[str]) -> str:
    """A version id that sorts after the earlier ones, also within one second."""
    moment = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    if earlier:
        last = datetime.strptime(earlier[-1].rsplit("-", 1)[0], _STAMP)
        moment = max(moment, last + timedelta(seconds=1))
    return f"{moment.strftime(_STAMP)}-{uuid.uuid4().hex[:5]}"


def _swapped(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``df`` with some texts replaced one after the other in all of its text columns."""
    out = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            col = F.col(f"`{field.name}`")
            for old, new in pairs:
                col = F.replace(col, F.lit(old), F.lit(new))
            out[field.name] = col
    return df.withColumns(out) if out else df


def release_snapshot(
    df: DataFrame, root: str, name: str, *, format: str = "parquet", release: bool = False
) -> str:
    """Write ``df`` as a new version of ``name`` and return its path.

    Without ``release`` nothing is written.  In CSV files a row is always one line: line breaks within
    texts are written as ``\\n`` and ``\\r``, and backslashes as ``\\b``; :func:`read_snapshot` turns them back.
    """
    if format not in FORMATS:
        raise ValueError(f"Unknown snapshot format '{format}', use one of {FORMATS}")
    if not release:
        return NOT_RELEASED
    version = _new_version(snapshot_versions(df.sparkSession, root, name))
    path = f"{root.rstrip('/')}/{name}/version={version}"
    # Breaks are escaped after backslashes, and turned back before them.
    writer = (_swapped(df, list(_ESCAPES.items())) if format == "csv" else df).write.mode("errorifexists")
    if format == "csv":
        # The writer would trim cells otherwise.
        whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer = writer.options(**CSV_OPTIONS, **whole, nullValue=CSV_NULL)
    writer.format(format).save(path)
    if format == "csv":
        write_text(df.sparkSession, f"{path}/{_ESCAPED}", "")
    return path


def snapshot_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Version ids of a snapshot, oldest first."""
    folder = f"{root.rstrip('/')}/{name}"
    prefix = "version="
    # A version without the success marker was not written to its end.
    return [
        entry.removeprefix(prefix)
        for entry in list_names(spark, folder)
        if entry.startswith(prefix) and exists(spark, f"{folder}/{entry}/_SUCCESS")
    ]


def read_snapshot(
    spark: SparkSession,
    root: str,
    name: str,
    version: str | None = None,
    *,
    format: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """One version of a snapshot, by default the newest.

    CSV keeps no types, so give ``schema`` to read a CSV snapshot as it was.  Its files are split over tasks
    by lines, unless they are from a time when a row could have several.
    """
    versions = snapshot_versions(spark, root, name)
    if not versions:
        raise ValueError(f"Snapshot {name} does not exist.")
    version = version or versions[-1]
    if version not in versions:
        raise ValueError(f"Snapshot {name} has no version {version}.")
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    path = f"{root.rstrip('/')}/{name}/version={version}"
    if format != "csv":
        return reader.load(path)
    lines = exists(spark, f"{path}/{_ESCAPED}")
    frame = reader.options(**CSV_OPTIONS, multiLine=not lines, nullValue=CSV_NULL).load(path)
    return _swapped(frame, [(new, old) for old, new in reversed(_ESCAPES.items())]) if lines else frame


def read_release(
    spark: SparkSession, root: str, name: str, database_version: str | float, releases: DataFrame, **options
) -> DataFrame:
    """The snapshot version that belongs to a database release.

    ``releases`` lists ``database_version``, ``name`` and ``version``; a release
    is found with or without a leading "v".
    """
    label = str(database_version).removeprefix("v")
    rows = (
        releases.filter(
            (F.regexp_replace(F.col("database_version").cast("string"), "^v", "") == label)
            & (F.col("name") == name)
        )
        .select("version")
        .limit(2)
        .collect()
    )
    if len(rows) != 1:
        raise ValueError(f"Release {database_version} has {len(rows)} entries for snapshot {name}, not 1.")
    return read_snapshot(spark, root, name, rows[0]["version"], **options)
