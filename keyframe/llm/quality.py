"""Quality rules: text statistics, and a decision list learned from labels.

Statistics of whole texts are built-in functions on arrays of words.  The list is learned by
sequential covering: a rule is a conjunction of thresholds that finds bad documents; it
grows, literal by literal, where it gains most on two thirds of the labelled rows,
loses its last literals where the other third says so, and is taken if it is right there often
enough; rows it covers are set aside for the next rule.  Each step is one small
aggregation of counts by feature and bin.  The result is an ordered CASE expression.

Defined results: a null text has no words and fails the base rule; documents without labels and
null labels teach nothing; of equal gains the first literal by feature, side and threshold
is taken; without labels there are no rules and all that pass the base rule are kept; repeated
documents and labels count each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import documents, staged

MIN_WORDS = 50
MAX_REPEATED = 50
BINS = 16
MAX_RULES = 8
MAX_LITERALS = 3
MIN_COVERED = 5
MIN_PRECISION = 0.9

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"


def with_statistics(docs: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys`` and the statistics of each whole text."""
    words, at, sorted_at = F.col("_words"), F.col("_at"), F.col("_sorted")
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return (
        docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .withColumns(
            {
                "_words": F.array_remove(F.split("_text", SPACES), ""),
                "_lines": lines,
                "word_chars": F.length(F.translate("_text", WHITE, "")).cast("long"),
                "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
                "n_upper": F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long"),
                "n_digits": F.length(F.regexp_replace("_text", "[^0-9]+", "")).cast("long"),
            }
        )
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                # Three-word windows as (hash, place), sorted, so that equal windows stand side by side.
                "_sorted": F.sort_array(
                    F.transform(
                        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
                        lambda w, i: F.struct(
                            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
                        ),
                    )
                ),
            }
        )
        .withColumn(
            "_at",
            F.sort_array(
                F.transform(
                    F.filter(
                        sorted_at,
                        lambda x, i: F.coalesce(F.get(sorted_at, i + 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce((i > 0) & (F.get(sorted_at, i - 1)["h"] == x["h"]), F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        .withColumn(
            "n_repeat_words",
            F.aggregate(
                at,
                F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
                lambda seen, i: F.struct(
                    (i + 3).alias("end"), (seen["n"] + i + 3 - F.greatest(i, seen["end"])).cast("long").alias("n")
                ),
                lambda seen: seen["n"],
            ),
        )
        .drop("_text", "_words", "_lines", "_sorted", "_at")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules may ask for: sizes, and shares that do not depend on size."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "digit_share": F.col("n_digits") / chars,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


@dataclass(frozen=True)
class Literal:
    """A feature at most, or above, its ``bin``-th threshold."""

    feature: int
    above: bool
    bin: int

    def on_bins(self, bins: Column) -> Column:
        own = F.get(bins, F.lit(self.feature))
        return own > self.bin if self.above else own <= self.bin


Rule = tuple[Literal, ...]


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def _counts(rows: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """(bad, good) rows by feature and bin."""
    found = (
        rows.select("bad", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("feature", "bin")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    )
    return {(r["feature"], r["bin"]): (r["bad"], r["good"]) for r in found.collect()}


def _best_literal(counts: dict, thresholds: list[list[float]], bad: int, good: int) -> tuple[float, Literal] | None:
    """The literal of the highest gain: bad rows kept, times the bits by which they got purer."""
    if not bad:
        return None
    now, best = log2(bad / (bad + good)), None
    for feature, cuts in enumerate(thresholds):
        below = [0, 0]
        for cut in range(len(cuts)):
            own = counts.get((feature, cut), (0, 0))
            below = [below[0] + own[0], below[1] + own[1]]
            for above, (p, n) in ((False, below), (True, [bad - below[0], good - below[1]])):
                if p >= MIN_COVERED and (gain := p * (log2(p / (p + n)) - now)) > 0:
                    if best is None or gain > best[0]:
                        best = gain, Literal(feature, above, cut)
    return best


def _grown(rows: DataFrame, thresholds: list[list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_LITERALS:
        counts = _counts(rows.where(_all([x.on_bins(F.col("bins")) for x in rule])))
        bad, good = (sum(v[k] for (f, _), v in counts.items() if f == 0) for k in (0, 1))
        if not good or (best := _best_literal(counts, thresholds, bad, good)) is None:
            break
        rule += (best[1],)
    return rule


def _pruned(rows: DataFrame, rule: Rule) -> tuple[Rule, float]:
    """The shortest beginning of the rule that is right most often on other rows, and how often."""
    sums = []
    for k in range(1, len(rule) + 1):
        holds = _all([x.on_bins(F.col("bins")) for x in rule[:k]])
        sums += [F.sum(F.when(holds, F.col("bad"))).alias(f"bad{k}"), F.count_if(holds).alias(f"all{k}")]
    found = rows.agg(*sums).first()
    worth = [((found[f"bad{k}"] or 0) + 1) / (found[f"all{k}"] + 2) for k in range(1, len(rule) + 1)]
    best = max(range(len(rule)), key=lambda k: (worth[k], -k))
    covered = found[f"all{best + 1}"]
    return rule[: best + 1], (found[f"bad{best + 1}"] or 0) / covered if covered >= MIN_COVERED else 0.0


def learn(labelled: DataFrame) -> tuple[list[Rule], list[list[float]]]:
    """Rules that find bad rows, in order, and the thresholds of each feature.

    ``labelled`` has the statistics, ``good`` (0 or 1) and ``_third`` (0, 1, 2), of which 2 is kept for pruning.
    """
    wanted = features()
    ranks = [k / BINS for k in range(1, BINS)]
    cuts = labelled.agg(*[F.percentile_approx(c, ranks, 10_000).alias(n) for n, c in wanted.items()]).first()
    thresholds = [sorted(set(cuts[n] or [])) for n in wanted]
    bins = F.array(
        *[
            sum((F.when(c > t, 1).otherwise(0) for t in own), F.lit(0))
            for c, own in zip(wanted.values(), thresholds)
        ]
    )
    rows = staged(labelled.select((1 - F.col("good")).alias("bad"), "_third", bins.alias("bins")), "quality-bins")
    left, rules = rows, []
    while len(rules) < MAX_RULES:
        rule = _grown(left.where("_third < 2"), thresholds)
        if not rule:
            break
        rule, right = _pruned(left.where("_third = 2"), rule)
        if right < MIN_PRECISION:
            break
        rules.append(rule)
        left = left.where(~_all([x.on_bins(F.col("bins")) for x in rule]))
    return rules, thresholds


def verdict(rules: list[Rule], thresholds: list[list[float]]) -> Column:
    """CASE WHEN rule THEN false WHEN ... ELSE true END on the statistics."""
    wanted = list(features().values())
    out = None
    for rule in rules:
        tests = []
        for x in rule:
            at = F.lit(thresholds[x.feature][x.bin])
            tests.append(wanted[x.feature] > at if x.above else wanted[x.feature] <= at)
        out = (F.when if out is None else out.when)(_all(tests), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for every document."""
    stats = staged(with_statistics(documents(spark, sf_dir), ["doc_id"]), "quality")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality").isNotNull())
    labelled = (
        stats.where(~base_failed())
        .join(labels.select("doc_id", F.col("quality").cast("int").alias("good")), "doc_id")
        .withColumn("_third", F.pmod(F.xxhash64("doc_id", F.lit("third")), F.lit(3)))
    )
    rules, thresholds = learn(labelled)
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & verdict(rules, thresholds)).alias("kept"),
    )
