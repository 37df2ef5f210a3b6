"""Folders on the file system Spark uses, and staging of intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Quotes inside of quoted cells are doubled, as in RFC 4180; backslashes mean nothing.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def scratch_dir(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, or else a folder in Spark's warehouse.

    Every session has a warehouse, and on a cluster all executors share it.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/keyframe-scratch"


def stage_in(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`stage`, with the folder of the files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage, so that several passes do not compute ``df`` again,
    and gives Spark the true size, so that a small frame can be broadcast.
    Staged files survive lost executors.
    """
    return stage_in(df, label)[0]


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As :func:`stage`, for use within a ``with`` block, at whose end the files are deleted."""
    frame, path = stage_in(df, label)
    try:
        yield frame
    finally:
        delete_folder(df.sparkSession, path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; empty if there is no such folder."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file that the driver keeps notes in."""
    fs, file = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under another name first, so that it is there as a whole or not at all."""
    fs, draft = _file_system(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, f"{path}.draft", path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; nothing happens if that is done already."""
    fs, old = _file_system(spark, source)
    if fs.exists(old) and not fs.rename(old, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"Cannot rename {source} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)
