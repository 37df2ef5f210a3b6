"""Decision lists and mixing with a budget against plain versions of the whole result."""

from collections import Counter
from math import log2

import pytest
from pyspark.sql import functions as F

from keyframe.llm import mixing, quality

FOLDER = "/root/testdata/sf0.01"


def plain_rules(rows, thresholds):
    """Sequential covering on (bins, bad, third) rows, with nothing but loops."""

    def holds(rule, bins):
        return all(bins[f] > cut if above else bins[f] <= cut for f, above, cut in rule)

    rules, left = [], rows
    while len(rules) < quality.MAX_RULES:
        rule = []
        while len(rule) < quality.MAX_LITERALS:
            own = [r for r in left if r[2] < 2 and holds(rule, r[0])]
            bad = sum(r[1] for r in own)
            if not bad or bad == len(own):
                break
            best = None
            for f, cuts in enumerate(thresholds):
                for cut in range(len(cuts)):
                    for above in (False, True):
                        some = [r for r in own if holds([(f, above, cut)], r[0])]
                        p = sum(r[1] for r in some)
                        if p >= quality.MIN_COVERED:
                            gain = p * (log2(p / len(some)) - log2(bad / len(own)))
                            if gain > 0 and (best is None or gain > best[0]):
                                best = gain, (f, above, cut)
            if best is None:
                break
            rule.append(best[1])
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            own = [r for r in left if r[2] == 2 and holds(rule[:k], r[0])]
            worth.append(((sum(r[1] for r in own) + 1) / (len(own) + 2), -k, sum(r[1] for r in own), len(own)))
        value, minus, bad, many = max(worth)
        if many < quality.MIN_COVERED or bad / many < quality.MIN_PRECISION:
            break
        rules.append(rule[:-minus])
        left = [r for r in left if not holds(rules[-1], r[0])]
    return rules, holds


def test_decision_list_and_verdicts(spark):
    stats = quality.staged(quality.with_statistics(spark.read.parquet(f"{FOLDER}/documents.parquet"), ["doc_id"]), "test")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality is not None}
    wanted = quality.features()
    third = F.pmod(F.xxhash64("doc_id", F.lit("third")), F.lit(3))
    values = stats.select("doc_id", quality.base_failed().alias("failed"), third.alias("third"), *[c.alias(f"f{k}") for k, c in enumerate(wanted.values())]).collect()
    labelled = stats.where(~quality.base_failed()).join(
        spark.createDataFrame([(d, int(q)) for d, q in labels.items()], "doc_id long, good int"), "doc_id"
    ).withColumn("_third", third)
    rules, thresholds = quality.learn(labelled)
    assert rules, "something is learned from these labels"
    bins = {r.doc_id: [sum(r[f"f{k}"] > t for t in own) for k, own in enumerate(thresholds)] for r in values}
    rows = [(bins[r.doc_id], 1 - int(labels[r.doc_id]), r.third) for r in values if r.doc_id in labels and not r.failed]
    plain, holds = plain_rules(rows, thresholds)
    assert [[(x.feature, x.above, x.bin) for x in rule] for rule in rules] == plain
    kept = {r.doc_id: not r.failed and not any(holds(rule, bins[r.doc_id]) for rule in plain) for r in values}
    got = {r.doc_id: r.kept for r in quality.op5_quality(spark, FOLDER).collect()}
    assert got == kept and 0 < sum(kept.values()) < len(kept)


def fill(weights, tokens, whole):
    """The factor by which weights, cut at their tokens, add up to ``whole``."""
    if sum(tokens.values()) <= whole:
        return max(tokens[k] / weights[k] for k in weights)
    low, high = 0.0, max(tokens[k] / weights[k] for k in weights)
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(weights[k] * middle, tokens[k]) for k in weights) < whole:
            low = middle
        else:
            high = middle
    return high


@pytest.mark.parametrize("budget", [0.2, 0.5, 0.9])
def test_raking_with_a_budget_as_loops_do(spark, budget):
    tokens = {(s, v, t): 7.0 * (i + 1) ** 2 + 90 * j + 31 * k for i, s in enumerate("abcd") for j, v in enumerate("xy") for k, t in enumerate("pq")}
    shares = {"source": {"a": 4.0, "b": 1.0, "c": 1.0, "d": 2.0}, "lang": {"x": 1.0, "y": 2.0}, "topic": {"p": 1.0, "q": 1.0}}
    targets = spark.createDataFrame([(n, v, w) for n, own in shares.items() for v, w in own.items()], "dimension string, value string, share double")
    cells = spark.createDataFrame([(*k, v) for k, v in tokens.items()], f"{', '.join(c + ' string' for c in mixing.CELL)}, tokens double")
    whole = budget * sum(tokens.values())
    goals = []
    for d, name in enumerate(mixing.DIMENSIONS):
        has = Counter()
        for k, v in tokens.items():
            has[k[d]] += v
        scale = fill(shares[name], has, whole)
        goals.append({v: min(w * scale, has[v]) for v, w in shares[name].items()})
    weight = {k: v * budget for k, v in tokens.items()}
    for _ in range(mixing.MAX_SWEEPS):
        off = 0.0
        for d in range(3):
            now = Counter()
            for k, v in weight.items():
                now[k[d]] += min(v, tokens[k])
            factor = {v: goals[d][v] / now[v] for v in goals[d]}
            off = max([off, *(abs(f - 1) for f in factor.values())])
            weight = {k: v * factor[k[d]] for k, v in weight.items()}
        if off <= mixing.TOLERANCE:
            break
    scale = fill(weight, tokens, whole)
    want = {k: min(1.0, weight[k] * scale / tokens[k]) for k in tokens}
    got = {tuple(r[c] for c in mixing.CELL): r._mix_chance for r in mixing.chances(cells, targets, budget).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want)
    assert abs(sum(got[k] * tokens[k] for k in got) - whole) < 1e-6 * whole
