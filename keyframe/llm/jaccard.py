"""N-gram Jaccard join by vertical partitioning, and the groups its links make.

Every text is a set of hashed word n-grams.  All n-grams stand in one global order, which is
cut into fragments; each fragment is a task that sees its own n-grams of all texts.

1. Texts of one set are one node from here on (``node`` is a hash of the set), so
   copies cost one row for each task.
2. Fragments count n-grams over all documents.  The order is: n-grams that are not common, by hash,
   then common ones, rarest first.  Common ones are those that at least ``total / COMMON_BOUND`` documents
   have, so there are at most ``COMMON_BOUND`` of them, which bounds their broadcast.  (Counts are
   taken on the part of the hash range that prefixes come from.)
3. Linked sets share one of the first ``n - ceil(0.8 n) + 1`` n-grams in that order.  Fragments of these
   prefixes list the nodes of each n-gram (``postings``).
4. Candidates: each node of a posting with the posting's leader, so a posting of m nodes gives m - 1
   pairs, not m squared.  A node's least leader comes first; its pairs with other leaders follow where links have not
   joined the two yet.  Overlaps are counted fragment by fragment and added up per pair: first in the
   fragment of the lowest hashes (``sketch``, a quarter of the range), where too many differences
   already rule a pair out, then, for the pairs that are left, in all of them, which decides exactly.
   Verified links make components.
5. What is left are pairs of one posting in different components; only these can still change the result.
   A node's cluster is its least leader.  Within a cluster, nodes outside of its largest component
   are compared with all of it in blocks of ``BLOCK`` nodes and ``BLOCK_GRAMS`` n-grams at most: fragment by fragment, a task counts the
   overlaps of two blocks as matrices, adds them up, and returns one link of a node for
   each component, never pairs.  Across clusters, pairs of a posting are joined under the length and
   positional filters and verified.  Sketches go first in both cases.  Nothing is capped.

Defined results: texts without words (null, empty, blank) have no n-grams and no links; texts with fewer
words than n have one n-gram, all their words; a null id takes part in no link and gets a
null component; repeated rows are reported each.  Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.components import components
from keyframe.llm.stage import documents, staged
from keyframe.llm.words import Texts, mix, runs, slices

WORDS = 5
# Similarity as a fraction, so that tests are exact.
SIMILAR = (4, 5)
COMMON_BOUND = 1 << 20
COMMON_LEAST = 32
COUNTED = 3 << 61  # counts are taken of hashes below this, three eighths of the range
FRAGMENT_BYTES = 8 << 20
POSTED_BYTES = 4 << 20  # of postings, which are sorted with their nodes and places
LEAST_FRAGMENTS = 64
PARTS = 4
FLUSH = 1 << 18
SLICE = 1 << 18  # bytes of text whose sets a task makes at once
BLOCK = 2_048
BLOCK_GRAMS = 1 << 20
COLUMNS = 4_096
# Sketches hold the highest 16 bits of the hashes below this, a quarter of the range.  Equal bits of different n-grams only
# make sets look more alike, so sketches rule out too few pairs, never too many.
SKETCHED = 1 << 62
BUCKETS = 1 << 21  # a wanted document is told from most others by its bucket, of which there are no more


def shingle_sets(texts: Texts, n: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    starts, ends, first = texts.words()
    grams, at = runs(texts.hashes(starts, ends), first, n)
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        own = np.sort(grams[low:high])
        yield own[np.concatenate(([True], own[1:] != own[:-1]))] if high > low + 1 else own


def set_key(own: np.ndarray) -> int:
    """A hash of a set, as a signed 64-bit integer."""
    value = mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))
    return int(mix(value).view(np.int64)[0])


def prefix_length(n: int) -> int:
    return n - -(-n * SIMILAR[0] // SIMILAR[1]) + 1


def set_of(batch: pa.Array) -> pa.Array:
    """Size, node and sketch of the set of each whole text; a null node for an empty set."""
    sizes, keys, sketches = [], [], []
    for start, stop in slices(batch, SLICE):
        for own in shingle_sets(Texts(batch[start:stop])):
            sizes.append(len(own))
            keys.append(set_key(own) if len(own) else None)
            low = own[: np.searchsorted(own, np.uint64(SKETCHED))]
            sketches.append(np.unique((low >> np.uint64(46)).astype(np.uint16)).tobytes())
    columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(sketches, pa.binary())]
    return pa.StructArray.from_arrays(columns, ["n", "node", "sketch"])


def _each_set(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[np.ndarray]:
    for batch in batches:
        for start, stop in slices(batch.column(column), SLICE):
            yield from shingle_sets(Texts(batch.column(column)[start:stop]))


def _fragment(hashes: np.ndarray, fragments: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(fragments)).astype(np.int32)


def _short(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """What stands for an n-gram in counts and postings: its fragment and 32 bits of its hash."""
    return (_fragment(hashes, fragments).astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _by_fragment(short: np.ndarray, fragments: int, *columns: np.ndarray) -> Iterator[tuple]:
    """Each fragment with its hashes and the other columns, as bytes."""
    order = np.argsort(short, kind="stable")
    short = short[order]
    bounds = np.searchsorted(short, np.arange(fragments + 1, dtype=np.uint64) << np.uint64(32))
    columns = [short.astype(np.uint32), *(c[order] for c in columns)]
    for f in np.flatnonzero(np.diff(bounds)):
        yield (int(f), *(c[bounds[f] : bounds[f + 1]].tobytes() for c in columns))


def _rows(found: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    for f, *columns in found:
        arrays = [pa.array([f], pa.int32()), *(pa.array([c], pa.large_binary()) for c in columns)]
        yield pa.RecordBatch.from_arrays([arrays[0], *(a.cast(pa.binary()) for a in arrays[1:])], names)


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def common_grams(texts: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Common n-grams in their short form, sorted, and the documents that have each; and the fragments."""
    fragments = max(LEAST_FRAGMENTS, -(-total * 4 * 3 // 8 // FRAGMENT_BYTES))
    least = max(COMMON_LEAST, -(-total // COMMON_BOUND))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for own in _each_set(batches):
            own = own[: np.searchsorted(own, np.uint64(COUNTED))]
            held.append(own)
            size += len(own)
            if size >= FLUSH:
                yield from counts(np.concatenate(held))
                held, size = [], 0
        if size:
            yield from counts(np.concatenate(held))

    def counts(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Hashes that occur once in this part of the task are sent without a count."""
        short, times = np.unique(_short(hashes, fragments), return_counts=True)
        often = times > 1
        names = ["fragment", "grams", "times"]
        yield from _rows(((f, own, b"") for f, own in _by_fragment(short[~often], fragments)), names)
        yield from _rows(_by_fragment(short[often], fragments, times[often].astype(np.uint32)), names)

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        grams, times = [], []
        for own, number in zip(table.column("grams").to_pylist(), table.column("times").to_pylist()):
            grams.append(np.frombuffer(own, np.uint32))
            times.append(np.frombuffer(number, np.uint32) if number else np.ones(len(own) // 4, np.uint32))
        grams, times = np.concatenate(grams), np.concatenate(times)
        order = np.argsort(grams, kind="stable")
        grams, sums = grams[order], np.concatenate(([0], np.cumsum(times[order], dtype=np.int64)))
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        number = np.diff(sums[np.append(first, len(grams))])
        keep = number >= least
        short = (key[0].as_py() << 32) + grams[first[keep]].astype(np.int64)
        return pa.table({"gram": pa.array(short, pa.int64()), "number": pa.array(number[keep], pa.int64())})

    sent = texts.mapInArrow(send, "fragment int, grams binary, times binary")
    found = sent.groupBy("fragment").applyInArrow(gather, "gram long, number long").toArrow()
    grams = found.column("gram").to_numpy().astype(np.uint64)
    order = np.argsort(grams)
    return grams[order], found.column("number").to_numpy()[order], fragments


def postings(texts: DataFrame, common: tuple[np.ndarray, np.ndarray, int], total: int) -> DataFrame:
    """(gram, node, n, place, leader, leader_n): prefix n-grams of two or more nodes."""
    fragments = max(LEAST_FRAGMENTS, -(-total * 20 // 5 // POSTED_BYTES))
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, number, counted = shared.value
        seen, held, size = set(), [], 0
        for own in _each_set(batches):
            if not len(own) or (key := set_key(own)) in seen:
                continue
            seen.add(key)
            wanted = prefix_length(len(own))
            top = np.searchsorted(own, np.uint64(COUNTED))
            short = _short(own[:top], counted)
            at = np.minimum(np.searchsorted(grams, short), max(len(grams) - 1, 0))
            often = grams[at] == short if len(grams) else np.zeros(top, bool)
            rest = own[:top][~often]
            if len(rest) < wanted:
                rest = np.concatenate((rest, own[top:]))
            if len(rest) < wanted:
                late = own[:top][often]
                rest = np.concatenate((rest, late[np.lexsort((late, number[at[often]]))]))
            held.append((rest[:wanted], key, len(own)))
            size += wanted
            if size >= FLUSH:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        sizes = [len(x[0]) for x in held]
        columns = [
            np.repeat(np.array([x[1] for x in held], np.int64), sizes),
            np.repeat(np.array([x[2] for x in held], np.int32), sizes),
            np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
        ]
        found = _by_fragment(_short(np.concatenate([x[0] for x in held]), fragments), fragments, *columns)
        yield from _rows(found, ["fragment", "grams", "nodes", "sizes", "places"])

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        grams, nodes = _joined(table, "grams", np.uint32), _joined(table, "nodes", np.int64)
        sizes, places = _joined(table, "sizes", np.int32), _joined(table, "places", np.int32)
        order = np.lexsort((nodes, grams))
        grams, nodes, sizes, places = grams[order], nodes[order], sizes[order], places[order]
        fresh = np.ones(len(grams), bool)  # copies in other tasks sent the same rows
        fresh[1:] = (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1])
        grams, nodes, sizes, places = grams[fresh], nodes[fresh], sizes[fresh], places[fresh]
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        times = np.diff(np.append(first, len(grams)))
        many = np.repeat(times > 1, times)
        leader = np.repeat(first, times)[many]
        return pa.table(
            {
                "gram": (key[0].as_py() << 32) + grams[many].astype(np.int64),
                "node": nodes[many],
                "n": sizes[many],
                "place": places[many],
                "leader": nodes[leader],
                "leader_n": sizes[leader],
                "leader_place": places[leader],
            }
        )

    sent = texts.mapInArrow(send, "fragment int, grams binary, nodes binary, sizes binary, places binary")
    schema = "gram long, node long, n int, place int, leader long, leader_n int, leader_place int"
    return sent.groupBy("fragment").applyInArrow(gather, schema)


def _possible(n, place, other_n, other_place):
    """Whether sets of these sizes that share an n-gram at these places of the order may be linked.

    For the first shared n-gram of a linked pair this holds: all others stand after it in both sets.
    """
    most = 1 + F.least(n - place, other_n - other_place) - 1
    return (most * (SIMILAR[0] + SIMILAR[1]) >= SIMILAR[0] * (n + other_n)) & (
        F.least(n, other_n) * SIMILAR[1] >= F.greatest(n, other_n) * SIMILAR[0]
    )


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct unordered pairs with sizes, the lesser node first."""
    swap = F.col("node") > F.col("other")
    pick = lambda yes, no: F.when(swap, F.col(yes)).otherwise(F.col(no))
    return found.select(
        pick("other", "node").alias("a"), pick("node", "other").alias("b"),
        pick("other_n", "n").alias("a_n"), pick("n", "other_n").alias("b_n"),
    ).distinct()


def set_parts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, part, grams): the sets of wanted (doc_id, node) rows, cut into ``PARTS`` fragments."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0), SLICE):
                nodes = batch.column(1)[start:stop].to_pylist()
                keys, parts, grams = [], [], []
                for node, own in zip(nodes, shingle_sets(Texts(batch.column(0)[start:stop]))):
                    if not len(own) or set_key(own) != node:  # another text of the same id
                        continue
                    bounds = np.searchsorted(own, np.arange(1, PARTS, dtype=np.uint64) * np.uint64((1 << 64) // PARTS))
                    for part, piece in enumerate(np.split(own, bounds)):
                        keys.append(node)
                        parts.append(part)
                        grams.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(parts, pa.int32()), pa.array(grams, pa.binary())],
                    ["node", "part", "grams"],
                )

    # A bounded broadcast keeps most other texts out of the shuffle.
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).alias("bucket")
    buckets = wanted.select(bucket).distinct()
    near = docs.select("doc_id", "text", bucket).join(F.broadcast(buckets), "bucket", "left_semi")
    texts = near.join(wanted, "doc_id").select("text", "node")
    return texts.mapInArrow(cut, "node long, part int, grams binary")


def _close(left: pa.Array, right: pa.Array, left_n: pa.Array, right_n: pa.Array) -> pa.Array:
    """Whether sketches have few enough differences for sets of these sizes to be linked."""
    out = np.zeros(len(left), bool)
    for k, (a, b, m, n) in enumerate(zip(*(x.to_pylist() for x in (left, right, left_n, right_n)))):
        a, b = np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)
        shared = (b.take(np.searchsorted(b, a), mode="clip") == a).sum() if len(a) and len(b) else 0
        out[k] = _few(len(a) + len(b) - 2 * shared, m + n)
    return pa.array(out)


def _few(different, sizes):
    """Linked sets differ in at most this share of the sum of their sizes."""
    return different * (SIMILAR[0] + SIMILAR[1]) <= sizes * (SIMILAR[1] - SIMILAR[0])


def close(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches do not rule them out."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("a_sketch"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("b_sketch"))
    test = F.arrow_udf(_close, "boolean")("a_sketch", "b_sketch", "a_n", "b_n")
    return pairs.join(left, "a").join(right, "b").where(test).select("a", "b", "a_n", "b_n")


def _overlap(left: pa.Array, right: pa.Array) -> pa.Array:
    out = np.zeros(len(left), np.int32)
    for k, (a, b) in enumerate(zip(left.to_pylist(), right.to_pylist())):
        a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        if len(a) and len(b):
            out[k] = (b.take(np.searchsorted(b, a), mode="clip") == a).sum()
    return pa.array(out)


def verified(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) that are linked: overlaps are counted in each part and added up."""
    # Only the sets of these pairs are shuffled.
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    parts = parts.join(ends, "node", "left_semi")
    left = parts.select(F.col("node").alias("a"), "part", F.col("grams").alias("a_grams"))
    right = parts.select(F.col("node").alias("b"), F.col("part").alias("b_part"), F.col("grams").alias("b_grams"))
    # Parts are compared as numbers and not joined on, so that both sides use one shuffle of the parts by node.
    counted = pairs.join(left, "a").join(right, "b").where(F.abs(F.col("part") - F.col("b_part")) < 1).select(
        "a", "b", "a_n", "b_n", "part", F.arrow_udf(_overlap, "int")("a_grams", "b_grams").alias("shared")
    )
    each = counted.groupBy("a", "b", "a_n", "b_n", "part").agg(F.max("shared").alias("shared"))
    sums = each.groupBy("a", "b", "a_n", "b_n").agg(F.sum("shared").alias("shared"))
    union = F.col("a_n") + F.col("b_n") - F.col("shared")
    return sums.where(F.col("shared") * SIMILAR[1] >= union * SIMILAR[0]).select("a", "b")


def _block_counts(table: pa.Table, kind) -> tuple:
    """Nodes, sizes and labels of the two blocks, and the overlaps counted in each part and added up."""
    left = np.asarray(table.column("outside").to_numpy(zero_copy_only=False), bool)
    part, node = table.column("part").to_numpy(), table.column("node").to_numpy()
    sizes, labels = table.column("n").to_numpy(), table.column("label").to_numpy()
    grams = table.column("grams").to_pylist()

    def side(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes, first = np.unique(node[rows], return_index=True)
        return nodes, sizes[rows][first], labels[rows][first]

    own, other = side(np.flatnonzero(left)), side(np.flatnonzero(~left))
    shared = np.zeros((len(own[0]), len(other[0])), np.float32)
    held = [np.zeros(len(own[0]), np.int64), np.zeros(len(other[0]), np.int64)]
    for p in np.unique(part):
        sets = []
        for which, (nodes, count) in enumerate(((own[0], held[0]), (other[0], held[1]))):
            rows = np.flatnonzero((left if which == 0 else ~left) & (part == p))
            _, first = np.unique(node[rows], return_index=True)
            pieces = [np.frombuffer(grams[k], kind) for k in rows[first]]
            place = np.searchsorted(nodes, node[rows[first]])
            lengths = np.array([len(x) for x in pieces], np.int64)
            count[place] += lengths
            sets.append((np.concatenate(pieces) if pieces else np.zeros(0, kind), np.repeat(place, lengths)))
        both = np.intersect1d(np.unique(sets[0][0]), np.unique(sets[1][0]), assume_unique=True)
        for low in range(0, len(both), COLUMNS):
            some = both[low : low + COLUMNS]
            dense = []
            for (values, at), count in zip(sets, shared.shape):
                to = np.minimum(np.searchsorted(some, values), len(some) - 1)
                hit = some[to] == values
                matrix = np.zeros((count, len(some)), np.float32)
                matrix[at[hit], to[hit]] = 1
                dense.append(matrix)
            shared += dense[0] @ dense[1].T
    return own, other, held, shared, own[2][:, None] != other[2][None, :]


def _block_close(key: tuple, table: pa.Table) -> pa.Table:
    """Nodes of two blocks that sketches do not tell apart from all nodes of other components."""
    own, other, held, shared, apart = _block_counts(table, np.uint16)
    different = held[0][:, None] + held[1][None, :] - 2 * shared
    may = _few(different, own[1][:, None] + other[1][None, :]) & apart
    return pa.table({"node": np.concatenate((own[0][may.any(axis=1)], other[0][may.any(axis=0)]))})


def _block_links(key: tuple, table: pa.Table) -> pa.Table:
    """Links of two blocks of a cluster: for each node of the first, one with each component of the second."""
    own, other, _, shared, apart = _block_counts(table, np.uint64)
    union = own[1][:, None] + other[1][None, :] - shared
    i, j = np.nonzero((shared * SIMILAR[1] >= union * SIMILAR[0]) & apart)
    _, once = np.unique(np.stack([i, other[2][j]]), axis=1, return_index=True) if len(i) else (None, np.zeros(0, int))
    return pa.table({"a": pa.array(own[0][i[once]], pa.int64()), "b": pa.array(other[0][j[once]], pa.int64())})


def blocks(clusters: DataFrame, grams: DataFrame):
    """Blocks of each cluster of several components, grouped; ``clusters`` has node, n, cluster and label.

    Nodes outside of the largest component stand in rows of blocks, all nodes in columns of blocks.
    """
    sizes = clusters.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("grams"))
    several = (
        sizes.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("labels"),
            F.sum("size").alias("all"),
            F.sum("grams").alias("all_grams"),
            F.max_by(F.struct("label", "size", "grams"), F.struct("size", "label")).alias("main"),
        )
        .where("labels > 1")
        .select(
            "cluster",
            F.col("main.label").alias("main"),
            F.expr(f"int(ceil(greatest((all - main.size) / {BLOCK}, (all_grams - main.grams) / {BLOCK_GRAMS})))").alias("rows"),
            F.expr(f"int(ceil(greatest(all / {BLOCK}, all_grams / {BLOCK_GRAMS})))").alias("columns"),
        )
    )
    live = clusters.join(several, "cluster")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    names = ("cluster", "node", "n", "label")
    outside = live.where(F.col("label") != F.col("main")).select(
        *names, F.lit(True).alias("outside"), own("rows").alias("i"), every("columns").alias("j")
    )
    all_of_it = live.select(*names, F.lit(False).alias("outside"), every("rows").alias("i"), own("columns").alias("j"))
    return outside.union(all_of_it).join(grams, "node").groupBy("cluster", "i", "j")


def across(lists: DataFrame, clusters: DataFrame) -> DataFrame:
    """Pairs of postings between different clusters and components that may be linked."""
    own = lists.select("gram", "node", "place").join(clusters, "node")
    several = (
        own.groupBy("gram")
        .agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.min("label").alias("l"), F.max("label").alias("h"))
        .where("low < high and l < h")
        .select("gram")
    )
    live = staged(own.join(several, "gram", "left_semi"), "jaccard-live")
    # Most nodes of a posting are in one cluster; those outside of it meet all.
    sizes = live.groupBy("gram", "cluster").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("gram").agg(F.max_by("cluster", F.struct("size", "cluster")).alias("main"))
    live = live.join(main, "gram")
    outside = live.where(F.col("cluster") != F.col("main")).drop("main")
    other = live.select(
        "gram", "main", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("place").alias("other_place"),
        F.col("label").alias("other_label"), F.col("cluster").alias("other_cluster"),
    )
    may = _possible(F.col("n"), F.col("place"), F.col("other_n"), F.col("other_place"))
    # Two outsiders meet twice; one order is enough.
    once = (F.col("other_cluster") == F.col("main")) | (F.col("node") < F.col("other"))
    apart = (F.col("cluster") != F.col("other_cluster")) & (F.col("label") != F.col("other_label"))
    return outside.join(other, "gram").where(apart & once & may)


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, node) of every document, and (node, label) of nodes in components of two or more."""
    named = docs.select("doc_id", F.arrow_udf(set_of, "struct<n: long, node: long, sketch: binary>")("text").alias("own"))
    nodes = staged(named.select("doc_id", "own.*"), "jaccard-nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    texts = docs.where(F.col("doc_id").isNotNull()).select("text")
    lists = staged(postings(texts, common_grams(texts, total), total), "jaccard-postings")
    listed = lists.groupBy("node").agg(F.first("n").alias("n"), F.min("leader").alias("cluster"))
    sketches = staged(
        nodes.where(F.col("doc_id").isNotNull())
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.max("sketch").alias("sketch"))
        .join(listed, "node"),
        "jaccard-sketches",
    )

    def sets(wanted: DataFrame) -> DataFrame:
        own = sketches.join(wanted.distinct(), "node", "left_semi").select("doc_id", "node")
        return staged(set_parts(docs, own), "jaccard-parts")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))

    first = lists.where(
        (F.col("node") != F.col("leader"))
        & _possible(F.col("n"), F.col("place"), F.col("leader_n"), F.col("leader_place"))
    ).select("node", "n", F.col("leader").alias("other"), F.col("leader_n").alias("other_n"))
    least = first.join(sketches.select("node", "cluster"), "node").where(F.col("other") == F.col("cluster")).drop("cluster")
    tried = staged(close(_pairs(least), sketches), "jaccard-pairs")
    links = staged(verified(tried, sets(ends(tried))), "jaccard-links")
    own = components(links)
    joined = _pairs(first).join(own.select(F.col("node").alias("a"), F.col("label").alias("a_label")), "a", "left")
    joined = joined.join(own.select(F.col("node").alias("b"), F.col("label").alias("b_label")), "b", "left")
    open_ = joined.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b", "a_n", "b_n")
    more = staged(close(open_.join(tried, ["a", "b"], "left_anti"), sketches), "jaccard-pairs")
    links = links.union(staged(verified(more, sets(ends(more))), "jaccard-links"))
    tried = tried.union(more)
    labels = components(links)
    clusters = sketches.select("node", "n", "cluster").join(labels, "node", "left")
    clusters = staged(clusters.withColumn("label", F.coalesce("label", "node")), "jaccard-clusters")
    flat = sketches.select("node", F.lit(0).alias("part"), F.col("sketch").alias("grams"))
    near = staged(blocks(clusters, flat).applyInArrow(_block_close, "node long").distinct(), "jaccard-near")
    rest = _pairs(across(lists, clusters)).join(tried, ["a", "b"], "left_anti")
    rest = staged(close(rest, sketches), "jaccard-pairs")
    parts = sets(near.union(ends(rest)))
    within = blocks(clusters.join(near, "node", "left_semi"), parts).applyInArrow(_block_links, "a long, b long")
    return nodes, components(links.union(within).union(verified(rest, parts)))


def with_component(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id that links reach) of every document."""
    nodes, labels = linked(docs)
    nodes = nodes.drop("sketch").join(labels, "node", "left").withColumn("_group", F.coalesce("label", "node"))
    least = nodes.where(F.col("_group").isNotNull()).groupBy("_group").agg(F.min("doc_id").alias("_least"))
    return nodes.join(least, "_group", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id")).alias("component_id"),
    )


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return with_component(documents(spark, sf_dir))
