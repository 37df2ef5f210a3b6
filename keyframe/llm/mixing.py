"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; topic is the layout of the text
(``topic``).  Token weights of the cells are raked: each sweep scales them to the target shares of
the sources, then of the languages, then of the topics, until no factor is further
than ``TOLERANCE`` from 1 (or, with a warning, ``MAX_SWEEPS``).  A cell's documents are kept with probability
``scale * raked weight / tokens``, or 1 if that is less; the scale is the one by which ``budget`` of
all tokens are kept in expectation (all tokens in the mix, if they are fewer).

A value that has fewer tokens than its share of the budget is kept whole, and the others share the
rest in proportion to their targets; sweeps count no cell's weight beyond its tokens.  So rare cells
take nothing from the others, and shares are the targets as far as the tokens go; ``shares`` gives
both.

Cells are counted with partial aggregation, so a hot source costs a row for each task; sweeps run
on cells alone, each dimension's sums in one window and without joins.  Targets are rows (dimension, value, share); values that
have none or no tokens are not in the mix, and shares of the rest are scaled to 1.  Without
targets, ``tempered`` takes shares of the present tokens to the power ``TEMPERATURE``.

Defined results: a null source or language is the value ``(none)``; null or blank texts have no
tokens and are never kept; repeated rows get equal draws and are kept or left together; an empty
table gives an empty result.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyframe.llm.stage import boxed, documents, staged, unboxed

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 1.0}
BUDGET = 0.5
TOLERANCE = 1e-6
MAX_SWEEPS = 30
SEED = 17
CELL = [f"_mix_{d}" for d in DIMENSIONS]
LOG = logging.getLogger(__name__)


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """The layout of a text: table, marks, list or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    bars = F.length(text) - F.length(F.translate(text, "|", ""))
    marks = F.length(text) - F.length(F.translate(text, "#*$%&<>{}=", ""))
    lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(NONE))
        .when(bars * 100 >= size, F.lit("table"))
        .when(marks * 50 >= size, F.lit("marks"))
        .when(size / lines < 60, F.lit("list"))
        .otherwise(F.lit("prose"))
    )


def with_cell(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of its cell, its tokens and its draw."""
    own = {
        "_mix_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        "_mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
        "_mix_topic": topic(F.col("text")),
        "_mix_tokens": n_tokens(F.col("text")),
        "_mix_draw": F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 52)) / F.lit(float(1 << 52)),
    }
    return docs.withColumns(own)


def cell_tokens(docs: DataFrame) -> DataFrame:
    """Tokens of each cell that has any."""
    return docs.groupBy(*CELL).agg(F.sum("_mix_tokens").cast("double").alias("tokens")).where("tokens > 0")


def tempered(cells: DataFrame) -> DataFrame:
    """Target shares in proportion to the tokens of each value to a power below 1."""
    parts = None
    for name, cell in zip(DIMENSIONS, CELL):
        own = cells.groupBy(F.col(cell).alias("value")).agg(F.pow(F.sum("tokens"), TEMPERATURE[name]).alias("share"))
        own = own.select(F.lit(name).alias("dimension"), "value", "share")
        parts = own if parts is None else parts.union(own)
    return parts


def _scale(rows: DataFrame, whole: float) -> float:
    """The factor by which ``weight``, cut at ``tokens``, adds up to ``whole``; if all are cut before, one that cuts all.

    The sum is concave in the factor, so Newton's steps from below come to it in finitely many rounds.
    """
    scale = 0.0
    while True:
        full = F.col("weight") * scale >= F.col("tokens")
        found = rows.agg(F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if not found["free"]:
            return scale
        fresh = (whole - (found["full"] or 0.0)) / found["free"]
        if fresh <= scale * (1 + 1e-9):
            return scale
        scale = fresh


def _goals(cells: DataFrame, targets: DataFrame, name: str, cell: str, whole: float) -> DataFrame:
    """Tokens wanted of each value of one dimension: in proportion to its target, but no more than it has."""
    wanted = targets.where(F.col("dimension") == name).groupBy(F.col("value").alias("_value")).agg(F.sum("share").alias("weight"))
    has = cells.groupBy(F.col(cell).alias("_value")).agg(F.sum("most").alias("tokens"))
    own = staged(wanted.join(has, "_value"), "mix-goals")
    return own.select("_value", F.least(F.col("weight") * _scale(own, whole), "tokens").alias("_goal"))


def _scaled(cells: DataFrame, goal: str, cell: str) -> DataFrame:
    """The cells with weights scaled to the goals of one dimension; of a weight, ``most`` counts at most."""
    # A sum beside the rows, not a join: sweeps are many, and each broadcast would hold memory of the driver.
    now = F.sum(F.least("weight", "most")).over(Window.partitionBy(cell))
    scaled = cells.withColumn("_factor", F.col(goal) / now)
    off = F.greatest("off", F.abs(F.col("_factor") - 1))
    return scaled.withColumns({"weight": F.col("weight") * F.col("_factor"), "off": off}).drop("_factor")


def _wanted(targets: DataFrame) -> DataFrame:
    return targets.select("dimension", "value", F.col("share").cast("double").alias("share")).where("share > 0")


def rake(cells: DataFrame, targets: DataFrame, budget: float | None = None) -> DataFrame:
    """Weights of the cells that are in the mix, whose sums by dimension have the target shares.

    Without a budget they add up to all tokens.  With one they add up to that part of the tokens, and
    of a cell's weight no more than its tokens counts.
    """
    whole = (cells.agg(F.sum("tokens")).first()[0] or 0.0) * (1.0 if budget is None else budget)
    targets = _wanted(targets)
    for name, cell in zip(DIMENSIONS, CELL):
        values = targets.where(F.col("dimension") == name).select(F.col("value").alias(cell))
        cells = cells.join(values, cell, "left_semi")
    most = F.lit(float("inf")) if budget is None else F.col("tokens")
    start = F.col("tokens") * (1.0 if budget is None else budget)
    now = staged(cells.withColumns({"weight": start, "most": most}), "mix-cells")
    goals = [_goals(now, targets, name, cell, whole) for name, cell in zip(DIMENSIONS, CELL)]
    for own, cell in zip(goals, CELL):  # goals stay the same, so they go with the cells
        now = now.join(own.select(F.col("_value").alias(cell), F.col("_goal").alias(f"{cell}_goal")), cell)
    for _ in range(MAX_SWEEPS):
        now = now.withColumn("off", F.lit(0.0))
        for cell in CELL:
            now = _scaled(now, f"{cell}_goal", cell)
        now = staged(now, "mix-cells")
        off = now.agg(F.max("off")).first()[0] or 0.0
        if off <= TOLERANCE:
            break
    else:
        LOG.warning("Targets are not met together: after %d sweeps a factor is still %.3g from 1", MAX_SWEEPS, off)
    return now.select(*CELL, "tokens", "weight")


def chances(cells: DataFrame, targets: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Tokens of each cell in the mix, and the chance of its documents to be kept."""
    raked = rake(cells, targets, budget)
    scale = _scale(raked, budget * (cells.agg(F.sum("tokens")).first()[0] or 0.0))
    chance = F.least(F.col("weight") * scale / F.col("tokens"), F.lit(1.0))
    return staged(raked.select(*CELL, "tokens", chance.alias("_mix_chance")), "mix-chance")


def shares(chance: DataFrame, targets: DataFrame) -> DataFrame:
    """(dimension, value, target, share): the share of the kept tokens that each value in the mix is to have, and has."""
    parts, wanted = None, _wanted(targets)
    for name, cell in zip(DIMENSIONS, CELL):
        own = chance.groupBy(F.col(cell).alias("value")).agg(F.sum(F.col("tokens") * F.col("_mix_chance")).alias("kept"))
        goal = wanted.where(F.col("dimension") == name).groupBy("value").agg(F.sum("share").alias("goal"))
        both = own.join(goal, "value").select(F.lit(name).alias("dimension"), "value", "goal", "kept")
        parts = both if parts is None else parts.union(both)
    sums = parts.groupBy("dimension").agg(F.sum("goal").alias("goals"), F.sum("kept").alias("whole"))
    return parts.join(sums, "dimension").select(
        "dimension", "value", (F.col("goal") / F.col("goals")).alias("target"), (F.col("kept") / F.col("whole")).alias("share")
    )


def mix(docs: DataFrame, targets: DataFrame | None = None, budget: float = BUDGET) -> DataFrame:
    """``docs`` with columns of cell, tokens, chance and draw; those with ``_mix_draw < _mix_chance`` are the sample."""
    docs = with_cell(docs)
    cells = staged(cell_tokens(docs), "mix-tokens")
    chance = chances(cells, tempered(cells) if targets is None else targets, budget).drop("tokens")
    return docs.join(chance, CELL, "left").withColumn("_mix_chance", F.coalesce("_mix_chance", F.lit(0.0)))


def sample(docs: DataFrame, targets: DataFrame | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled documents, with their own columns."""
    rows = boxed(docs, **{name: F.col(name) for name in ("doc_id", "text", "source", "lang")})
    return unboxed(mix(rows, targets, budget).where(F.col("_mix_draw") < F.col("_mix_chance")), docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, tokens, chance and fate of every document."""
    narrow = documents(spark, sf_dir).select("doc_id", "source", "lang", "text")
    return mix(narrow).select(
        "doc_id", "source", "lang", F.col("_mix_topic").alias("topic"), F.col("_mix_tokens").alias("n_tokens"),
        F.col("_mix_chance").alias("chance"), (F.col("_mix_draw") < F.col("_mix_chance")).alias("sampled"),
    )
