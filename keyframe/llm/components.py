"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyframe.llm.stage import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of ``links`` (a, b) is connected with.

    In each round a node takes the least label of itself and its neighbours, and then the label of
    that label, so chains shorten by half.  Minima are combined before the shuffle, so a node with
    many neighbours costs a row for each task.  Every round is written to the shared folder.
    """
    links = links.select("a", "b").where(F.col("a") != F.col("b"))
    both = staged(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels = staged(
        both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("near")
        )
        mixed = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("now"))
        up = labels.select(F.col("node").alias("now"), F.col("label").alias("up"))
        fresh = staged(
            mixed.join(up, "now", "left").select("node", "label", F.least("now", F.coalesce("up", "now")).alias("now")),
            "labels",
        )
        changed = not fresh.where(F.col("now") != F.col("label")).isEmpty()
        labels = fresh.select("node", F.col("now").alias("label"))
        if not changed:
            return labels
