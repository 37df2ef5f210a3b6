"""Hard negatives: rows of another label that score just below an anchor's positives, found exactly.

The method is anchor-clustered shared lists.  Anchors that point the same way form a cluster, around a centre
that no member is further from than some angle.  The scores of a candidate with all members then have one bound:
its length times the cosine of its angle with the centre less that angle.  A cluster sorts candidates by this bound
once; each member walks the sorted list in blocks and stops for certain as soon as its length times the bound cannot
reach what it still needs.

Spark deals the work: rows into shards of about ``SHARD``, clusters into groups of at most ``GROUP`` anchors, and a task
has one group and one shard.  It hands on at most k rows for each anchor (with positives: k for each of them), and
the best k of all shards follow in one window whose groups are cut before the shuffle.  A first job finds the
positives, a second one, which knows their scores, the negatives.  An anchor's needs rule out most of a list in the
second job: negatives must reach ``LOW`` percent of the positive's score.

Vectors become integers, ``floor(scale * x)``, and scores exact integer inner products.  Rows with a null id, label,
vector or component, or a component that is not finite, take no part.  Vectors of several lengths are compared as if the
shorter ones ended in zeros.  Repeated rows count once; of rows that share an id but differ, the first by label and vector
counts.  Ties go to the smaller id.  A score of ``2**62 / rows of a shard`` or more is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyframe.llm.stage import staged

SCALE = 256
K = 5
LOW, HIGH = 80, 100
SHARD = 1 << 13
GROUP = 1 << 12
# Anchors of one cluster at most; more are dealt to several.
CLUSTER = 1 << 10
PIVOTS = 64
STEP = 1 << 11
# Added to bounds, far above what doubles may be off by at these lengths.
SLACK = 1e-9

_NONE = np.iinfo(np.int64).min


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Whole vectors as rows of integers in doubles, zeros behind the shorter ones."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.asarray(vectors.flatten(), np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = flat
    return out


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(length, 1e-300)[:, None], length


def _best(keys: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """The ``k`` largest keys of each of ``n`` owners, falling; ``_NONE`` where there are fewer."""
    order = np.lexsort((~keys, owner))
    keys, owner = keys[order], owner[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    out = np.full((n, k), _NONE)
    kept = place < k
    out[owner[kept], place[kept]] = keys[kept]
    return out


class Shard:
    """The candidates of one task, by rising id, so that ties go to the earlier ones."""

    def __init__(self, table: pa.Table, width: int):
        order = np.argsort(np.asarray(table["vec_id"]), kind="stable")
        table = table.take(pa.array(order))
        self.ids, self.labels = np.asarray(table["vec_id"]), np.asarray(table["label"])
        self.x = _matrix(table["vector"], width)
        self.units, self.lengths = _units(self.x)
        self.bits = max(len(self.ids), 1).bit_length()

    def keys(self, scores: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integers that are in the order of scores, then of falling ids."""
        return (scores << self.bits) + (len(self.ids) - 1 - rows)

    def scores(self, keys: np.ndarray) -> np.ndarray:
        return np.where(keys == _NONE, _NONE, keys >> self.bits)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        return len(self.ids) - 1 - (keys & ((1 << self.bits) - 1))


class Cluster:
    """Some anchors, their centre, and the list of a shard's rows by falling bound."""

    def __init__(self, x: np.ndarray, shard: Shard):
        self.x, self.shard = x, shard
        units, self.lengths = _units(x)
        centre, _ = _units(units.sum(axis=0, keepdims=True))
        angle = lambda u: np.arccos(np.clip(u @ centre[0], -1.0, 1.0))
        # An anchor of length zero scores zero with every row, wherever it points.
        own = angle(units)[self.lengths > 0]
        widest = own.max() if len(own) else 0.0
        bound = shard.lengths * np.cos(np.maximum(angle(shard.units) - widest - SLACK, 0.0)) + SLACK
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        largest = float(self.lengths.max() * shard.lengths.max()) if len(x) and len(shard.ids) else 0.0
        if largest * 2.0**shard.bits >= 2.0**62:
            raise ValueError("Scores of vectors are too large")
        self.exact = largest < 2.0**52

    def walk(self, need) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(members, rows, scores) block by block; ``need()`` is the least score that each member still wants.

        A member stops when no later row can reach it, and the walk ends when all have stopped.
        """
        for begin in range(0, len(self.order), STEP):
            reach = self.lengths * self.bound[begin]
            active = np.flatnonzero(reach + SLACK * np.abs(reach) + 1.0 >= need())
            if not len(active):
                return
            rows = self.order[begin : begin + STEP]
            if self.exact:
                scores = (self.x[active] @ self.shard.x[rows].T).astype(np.int64)
            else:
                scores = self.x[active].astype(np.int64) @ self.shard.x[rows].astype(np.int64).T
            yield active, rows, scores


def _positives(members: dict, shard: Shard, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the best ``k`` rows of each member's label in this shard, the member itself excepted."""
    cluster = Cluster(members["x"], shard)
    best = np.full((len(members["x"]), k), _NONE)
    # No list of this shard need go below what the member has at hand among the anchors of its group.
    need = lambda: np.maximum(shard.scores(best[:, -1]).astype(np.float64), members["floor"])
    for active, rows, scores in cluster.walk(need):
        keys = shard.keys(scores, rows[None, :])
        fits = (members["label"][active][:, None] == shard.labels[rows][None, :]) & (members["id"][active][:, None] != shard.ids[rows][None, :])
        fits &= (keys > best[active, -1][:, None]) & (scores >= members["floor"][active][:, None])
        who, which = np.nonzero(fits)
        if len(who):
            own = best[active]
            held = np.repeat(np.arange(len(active)), k)
            best[active] = _best(np.concatenate([own.ravel(), keys[who, which]]), np.concatenate([held, who]), len(active), k)
    return best, shard.scores(best)


def _floors(members: dict, k: int) -> np.ndarray:
    """For each anchor the k-th best score with other anchors at hand of its label: its k-th positive is no worse."""
    out = np.full(len(members["x"]), -np.inf)
    for begin in range(0, len(out), STEP):
        part = slice(begin, begin + STEP)
        scores = members["x"][part] @ members["x"].T
        fits = (members["label"][part][:, None] == members["label"][None, :]) & (members["id"][part][:, None] != members["id"][None, :])
        scores = np.where(fits, scores, -np.inf)
        if scores.shape[1] >= k:
            out[part] = np.partition(scores, -k, axis=1)[:, -k]
    return out


def _negatives(members: dict, shard: Shard, k: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each place among the positives: keys of the best ``k`` rows of other labels within their band."""
    cluster = Cluster(members["x"], shard)
    positive = members["positive"]  # (members, places), NaN where there is none
    places = positive.shape[1]
    # Smallest and largest whole score of each band; a negative positive score has none.
    floor, roof = np.ceil(low * positive / high), positive
    floor = np.where(np.isnan(floor) | (floor > roof), np.inf, floor)
    best = np.full((places, len(members["x"]), k), _NONE)
    need = lambda: np.minimum.reduce([np.maximum(floor[:, p], shard.scores(best[p, :, -1]).astype(np.float64)) for p in range(places)])
    for active, rows, scores in cluster.walk(need):
        wanted = need()[active]
        hits = (members["label"][active][:, None] != shard.labels[rows][None, :]) & (scores >= wanted[:, None])
        who, which = np.nonzero(hits)
        if not len(who):
            continue
        found = scores[who, which]
        keys = shard.keys(found, rows[which])
        for p in range(places):
            fits = (found >= floor[active[who], p]) & (found <= roof[active[who], p])
            if fits.any():
                own = best[p, active]
                held = np.repeat(np.arange(len(active)), k)
                best[p, active] = _best(np.concatenate([own.ravel(), keys[fits]]), np.concatenate([held, who[fits]]), len(active), k)
    for p in range(places):
        yield p, best[p]


def clusters_of(anchors: DataFrame, width: int) -> DataFrame:
    """``anchors`` with ``cluster`` and ``group``: each near one of ``PIVOTS`` anchors taken by hash.

    The pivots and the sizes of their clusters are the only things the driver sees.
    """
    spark = anchors.sparkSession
    chosen = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("vector").toArrow()
    pivots, _ = _units(_matrix(chosen["vector"], width))

    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        units, _ = _units(_matrix(vectors, width))
        return pa.array((units @ pivots.T).argmax(axis=1).astype(np.int32))

    near = staged(anchors.withColumn("pivot", nearest("vector")), "negatives-anchors")
    sizes = {r["pivot"]: r["count"] for r in near.groupBy("pivot").count().collect()}
    # Large clusters are cut by a hash of the id, and the parts are packed into groups one after the other.
    listed, group, filled = [], 0, 0
    for pivot, size in sorted(sizes.items()):
        parts = -(-size // (CLUSTER // 2))
        for part in range(parts):
            if filled and filled + size / parts > GROUP:
                group, filled = group + 1, 0
            filled += size / parts
            listed.append((pivot, parts, part, len(listed), group))
    plan = spark.createDataFrame(listed, "pivot int, parts int, part int, cluster int, group int")
    # The plan has a row for every CLUSTER / 2 anchors.
    parts = plan.select("pivot", "parts").distinct()
    dealt = near.join(parts, "pivot").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col("parts")).cast("int"))
    return dealt.join(plan.drop("parts"), ["pivot", "part"]).select(*anchors.columns, "cluster", "group")


def _members(table: pa.Table, width: int) -> dict:
    members = {"id": np.asarray(table["vec_id"]), "label": np.asarray(table["label"]), "cluster": np.asarray(table["cluster"])}
    return members | {"x": _matrix(table["vector"], width)}


def _by_cluster(members: dict) -> Iterator[tuple[np.ndarray, dict]]:
    for cluster in np.unique(members["cluster"]):
        at = np.flatnonzero(members["cluster"] == cluster)
        yield at, {n: v[at] for n, v in members.items()}


def _ranked(rows: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    """The first ``k`` rows of each group, with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def prepared(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one for each id, with integer vectors."""
    col = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    rows = embeddings.where("vec_id is not null and label is not null and embedding is not null").where(~F.exists(col, bad))

    @F.arrow_udf("array<double>")
    def whole(vectors: pa.Array) -> pa.Array:
        flat = np.floor(scale * np.asarray(vectors.flatten(), np.float64))
        if len(flat) and np.abs(flat).max() >= 2.0**31:
            raise ValueError(f"Components of vectors must be below 2**31 / {scale}")
        sizes = np.concatenate(([0], np.cumsum(np.diff(np.asarray(vectors.offsets))))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))

    first = F.min(F.struct(F.col("label").cast("long").alias("label"), "embedding")).alias("first")
    one = rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(first)
    return one.select("vec_id", "first.label", whole("first.embedding").alias("vector"))


def mine(rows: DataFrame, anchors: DataFrame, *, k: int = K, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are of :func:`prepared`'s form; an anchor is one of the rows.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not facts["n"] or anchors.isEmpty():
        return rows.sparkSession.createDataFrame([], schema)
    width = facts["width"]
    shards = -(-facts["n"] // SHARD)
    grouped = staged(clusters_of(anchors, width), "negatives-clusters")
    groups = grouped.agg(F.max("group")).first()[0] + 1
    # Each shard meets each group: shards go to every group, and the few anchors of a group to every shard.
    candidates = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit("shard")), F.lit(shards)).cast("int"))
    candidates = candidates.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")

    def best_positives(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"anchor_id": [], "positive_id": [], "positive_score": []}
        if len(left) and len(right):
            members, shard = _members(left, width), Shard(right, width)
            members["floor"] = _floors(members, k)
            for _, own in _by_cluster(members):
                keys, scores = _positives(own, shard, k)
                who, place = np.nonzero(keys != _NONE)
                found["anchor_id"] += own["id"][who].tolist()
                found["positive_id"] += shard.ids[shard.rows(keys[who, place])].tolist()
                found["positive_score"] += scores[who, place].tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    pairs = grouped.select("*", everywhere).groupBy("group", "shard").cogroup(candidates.groupBy("group", "shard"))
    positives = pairs.applyInArrow(best_positives, "anchor_id long, positive_id long, positive_score long")
    positives = staged(_ranked(positives, ["anchor_id"], "positive_score", "positive_id", k), "negatives-positives")
    held = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("places"))
    held = held.select("anchor_id", F.col("places.positive_id").alias("positive_ids"), F.col("places.positive_score").alias("positive_scores"))
    asked = grouped.join(held, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")

    def best_negatives(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        found: dict[str, list] = {n: [] for n in names}
        if len(left) and len(right):
            members, shard = _members(left, width), Shard(right, width)
            ids, scores = left["positive_ids"].to_pylist(), left["positive_scores"].to_pylist()
            members["positive"] = np.array([s + [np.nan] * (k - len(s)) for s in scores], np.float64)
            members["positive_id"] = np.array([i + [-1] * (k - len(i)) for i in ids], np.int64)
            for _, own in _by_cluster(members):
                for place, keys in _negatives(own, shard, k, low, high):
                    who, which = np.nonzero(keys != _NONE)
                    chosen = keys[who, which]
                    columns = (own["id"][who], own["positive_id"][who, place], own["positive"][who, place].astype(np.int64), shard.ids[shard.rows(chosen)], shard.scores(chosen))
                    for name, values in zip(names, columns):
                        found[name] += values.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    pairs = asked.select("*", everywhere).groupBy("group", "shard").cogroup(candidates.groupBy("group", "shard"))
    negatives = pairs.applyInArrow(best_negatives, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = _ranked(negatives, ["anchor_id", "positive_id"], "negative_score", "negative_id", k)
    return ranked.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100, against all rows."""
    rows = prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = staged(rows.withColumn("label", moved), "negatives-rows")
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


OP11_SQL = """
WITH given AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embeddings.label, embedding) = 1
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
           coalesce(CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.x, r.x)]) AS BIGINT), 0) AS score
    FROM given a JOIN given r ON a.vec_id <> r.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
