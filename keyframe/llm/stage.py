"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes in a batch of rows on their way to Python: both sides hold some batches for each task, outside of the heap.
BATCH_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or else Spark's warehouse, which every session has."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """From now on, rows go to Python in batches of ``BATCH_BYTES`` at most, unless the session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once as Parquet to the shared folder and read back.

    This cuts the lineage, survives lost executors, and tells Spark the true size.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id) -> "F.Column":
    """Whether a document belongs to the fifth that nothing is learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def boxed(docs: DataFrame, **needed) -> DataFrame:
    """Whole rows in one column ``_row``, beside the ``needed`` ones, so that no name of a document's column clashes."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("_row"), *[column.alias(name) for name, column in needed.items()])


def unboxed(rows: DataFrame, columns: list[str], **replaced) -> DataFrame:
    """The rows in ``_row`` again, with some columns replaced."""
    return rows.select(*[replaced.get(c, F.col("_row")[c]).alias(c) for c in columns])
