"""Benchmark decontamination by spaced-seed hashing.

A seed is a hash of the words at the ``1`` places of a fixed mask; words at the ``0`` places
do not matter, so a seed survives a substitution there.  Items of fewer than ``SHORT_ITEM`` words have lighter
masks too, which stay whole beside one changed word.

1. Tasks turn items and documents into seeds.  The benchmark's seeds set bits in a filter of ``2**FILTER_BITS`` bits,
   whatever their number; documents send only seeds that pass it.
2. Seeds of items and documents are joined by their hash.  A hit names a diagonal (document word minus item word); each
   diagonal of a document and an item is looked at once.
3. Words of documents along their diagonals are cut out where the texts are, ``LIST`` diagonals at a time, joined with
   the words of the items, and compared one by one: the best stretch, where a match counts 1 and a substitution
   ``-PENALTY``, is an overlap if it has ``MIN_MATCHED`` matching words.  An item too short for that overlaps if
   ``MIN_SHARE`` of its words match along the diagonal, wherever they stand.

Texts and items stand for themselves by digests of 128 bits, so copies are looked at once.  A document has one row, with
the item that it overlaps with most and the number of all of them (:func:`overlaps` has every pair of different texts).

Words are stretches of ASCII letters, digits and non-ASCII characters, A-Z lowered.

Defined results: null or empty texts and items overlap with nothing, and neither do items
of fewer than ``MIN_ITEM`` words.  Of several overlaps of a document with an item the longest
is reported, of equal ones the first; of several items with equal overlaps the one of the least id.  Repeated documents are reported
each; items that differ in their id only count each.  Items without an id count, and come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import boxed, documents, staged, unboxed
from keyframe.llm.words import LOWER, PLACE, Texts, mix, slices

MASKS = ("111111", "110110101", "1011001011", "1110010011")
SHORT_MASKS = ("1111", "11011")
SHORT_ITEM = 10
PENALTY = 3
MIN_MATCHED = 10
MIN_SHARE = 0.8
MIN_ITEM = 6
FILTER_BITS = 24
SLICE = 1 << 18  # bytes of text whose seeds a task holds at once
LIST = 1_000
# Documents are told from most others by a bucket of their text, of which there are no more.
BUCKETS = 1 << 21

# Bytes that separate words: all ASCII but digits and letters.
APART = np.zeros(256, bool)
APART[:128] = True
APART[ord("0") : ord("9") + 1] = APART[ord("A") : ord("Z") + 1] = APART[ord("a") : ord("z") + 1] = False

def _hashed(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = texts.words(APART)
    return texts.hashes(starts, ends, LOWER), first


def _masked(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of a mask, and the word each starts at; none reaches into the next text."""
    number = (*MASKS, *SHORT_MASKS).index(mask)
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.full(n, PLACE[200 + number], np.uint64)
    for j, sign in enumerate(mask):
        if sign == "1":
            value += hashes[j : j + n] * PLACE[j]
    inside = np.ones(n, bool)
    for j in range(1, len(mask)):
        cut = first[1:-1] - j
        inside[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(inside)
    return mix(value[at]), at


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _words(batch: pa.Array) -> pa.Array:
    """Hashed words of each whole text."""
    out = []
    for start, stop in slices(batch, SLICE):
        hashes, first = _hashed(Texts(batch[start:stop]))
        out += [hashes[low:high].tobytes() for low, high in zip(first[:-1].tolist(), first[1:].tolist())]
    return pa.array(out, pa.binary())


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_key, n, words) of every different text of the benchmark that is long enough."""
    own = benchmark.where(F.length("text") > 0).select(_key(F.col("text")).alias("item_key"), F.arrow_udf(_words, "binary")("text").alias("words"))
    sized = own.withColumn("n", (F.octet_length("words") / 8).cast("int")).where(F.col("n") >= MIN_ITEM)
    return sized.groupBy("item_key").agg(F.first("n").alias("n"), F.first("words").alias("words"))


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_key, place, n) of all items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds, keys, places, sizes = [], [], [], []
            for key, n, words in zip(*(batch.column(k).to_pylist() for k in range(3))):
                hashes, first = np.frombuffer(words, np.uint64), np.array([0, n])
                for mask in (*MASKS, *SHORT_MASKS) if n < SHORT_ITEM else MASKS:
                    value, at = _masked(hashes, first, mask)
                    seeds += value.view(np.int64).tolist()
                    places += at.tolist()
                    keys += [key] * len(at)
                    sizes += [n] * len(at)
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((seeds, keys, places, sizes), kinds)], ["seed", "item_key", "place", "n"])

    return items.select("item_key", "n", "words").mapInArrow(cut, "seed long, item_key binary, place int, n int")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """One bit for the first ``FILTER_BITS`` bits of every seed; as large for any number of seeds."""
    rest = 64 - FILTER_BITS
    slot = F.shiftrightunsigned("seed", rest)
    # 63 bits of each word of the filter are used, so that sums of different bits stay in range.
    words = seeds.select(slot.alias("slot")).distinct().groupBy(F.floor(F.col("slot") / 63).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot % 63))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros((1 << FILTER_BITS) // 63 + 1, np.int64)
    out[np.asarray(found["word"])] = np.asarray(found["bits"])
    return out


def _passes(seen: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    slot = (seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (seen[slot // 63] >> (slot % 63)) & 1 == 1


def document_seeds(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """(seed, text_key, at) of documents' seeds that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0), SLICE):
                hashes, first = _hashed(Texts(batch.column(0)[start:stop]))
                found = [_masked(hashes, first, mask) for mask in (*MASKS, *SHORT_MASKS)]
                found = [(value[ok], at[ok]) for value, at in found for ok in [_passes(shared.value, value)]]
                seeds, at = (np.concatenate(x) for x in zip(*found))
                text = np.searchsorted(first, at, "right") - 1
                keys = batch.column(1)[start:stop].take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds.view(np.int64)), keys, pa.array((at - first[text]).astype(np.int32))], ["seed", "text_key", "at"]
                )

    given = docs.where(F.length("text") > 0).select("text", _key(F.col("text")).alias("text_key"))
    return given.mapInArrow(send, "seed long, text_key binary, at int")


def _best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Matching words, start and end of the stretch of the highest score."""
    score = np.cumsum(np.where(same, 1, -PENALTY))
    before = np.concatenate(([0], score[:-1]))
    least = np.minimum.accumulate(before)
    end = int(np.argmax(score - least))
    start = int(np.flatnonzero(before[: end + 1] == least[end])[-1])
    return int(same[start : end + 1].sum()), start, end + 1


def overlap(same: np.ndarray, size: int) -> tuple[int, int, int] | None:
    """Matching words, start and end of the overlap along a diagonal of an item of ``size`` words; None if there is none."""
    if MIN_SHARE * size >= MIN_MATCHED:
        found = _best_stretch(same)
        return found if found[0] >= MIN_MATCHED else None
    at = np.flatnonzero(same)
    return (len(at), int(at[0]), int(at[-1]) + 1) if len(at) >= MIN_SHARE * size else None


def _verified(lows: pa.Array, item_lows: pa.Array, own: pa.Array, items: pa.Array, sizes: pa.Array) -> pa.Array:
    """The overlap along each diagonal, or null."""
    out = []
    for low, item_low, a, b, n in zip(*(x.to_pylist() for x in (lows, item_lows, own, items, sizes))):
        a = np.frombuffer(a, np.uint64)
        same = a == np.frombuffer(b, np.uint64)[item_low : item_low + len(a)]
        found = overlap(same, n)
        if found:
            matched, start, end = found
            found = {"n_matched": matched, "n_words": end - start, "doc_word": low + start, "item_word": item_low + start}
        out.append(found)
    return pa.array(out, pa.struct([(f, pa.int32()) for f in ("n_matched", "n_words", "doc_word", "item_word")]))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(text_key, item_key, n_matched, n_words, doc_word, item_word) of all different texts that overlap."""
    items = staged(item_words(benchmark), "leak-items")
    seeds = staged(item_seeds(items), "leak-seeds")
    hits = document_seeds(docs, seed_filter(seeds)).join(seeds, "seed")
    lines = staged(hits.select("text_key", "item_key", "n", (F.col("at") - F.col("place")).alias("lag")).distinct(), "leak-diagonals")
    # A text that meets very many items is cut in several tasks, each with a list of bounded length.
    number = lines.groupBy("text_key").agg(F.ceil(F.count(F.lit(1)) / LIST).alias("lists"))
    dealt = lines.join(number, "text_key").withColumn("list", F.pmod(F.xxhash64("item_key", "lag"), F.col("lists")))
    lists = dealt.groupBy("text_key", "list").agg(F.collect_list(F.struct("item_key", "lag", "n")).alias("lines"))
    keyed = docs.where(F.length("text") > 0).select("text", _key(F.col("text")).alias("text_key"))
    texts = keyed.join(number.select("text_key"), "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(0), SLICE):
                hashes, first = _hashed(Texts(batch.column(0)[start:stop]))
                keys, own = batch.column(1)[start:stop].to_pylist(), batch.column(2)[start:stop].to_pylist()
                out = []
                for t, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    for x in own[t]:
                        begin, end = max(x["lag"], 0), min(x["lag"] + x["n"], high - low)
                        out.append((keys[t], x["item_key"], begin, begin - x["lag"], hashes[low + begin : low + end].tobytes()))
                columns = list(zip(*out)) or [[]] * 5
                kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["text_key", "item_key", "low", "item_low", "own"]
                )

    lined = texts.join(lists, "text_key").select("text", "text_key", "lines").mapInArrow(
        cut, "text_key binary, item_key binary, low int, item_low int, own binary"
    )
    kind = "struct<n_matched: int, n_words: int, doc_word: int, item_word: int>"
    found = lined.join(items, "item_key").select("text_key", "item_key", F.arrow_udf(_verified, kind)("low", "item_low", "own", "words", "n").alias("x"))
    # The longest overlap of a text and an item, of equal ones the first.
    order = F.struct("x.n_matched", -F.col("x.doc_word"), -F.col("x.item_word"))
    return found.where("x is not null").groupBy("text_key", "item_key").agg(F.max_by("x", order).alias("x")).select("text_key", "item_key", "x.*")


def contaminated(docs: DataFrame, benchmark: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each document that overlaps: ``keys``, the item it overlaps with most, where, and ``n_items`` in all."""
    pairs = staged(overlaps(docs.select("text"), benchmark), "leak-pairs")
    ids = benchmark.where(F.length("text") > 0).select("item_id", _key(F.col("text")).alias("item_key"))
    ids = ids.groupBy("item_key").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("ids"))
    named = pairs.join(ids, "item_key")
    # Of equally long overlaps that of the least item; items without an id come last.
    row = F.struct("item_id", "n_matched", "n_words", "doc_word", "item_word")
    order = F.struct(-F.col("n_matched"), F.col("item_id").isNull(), "item_id", "doc_word", "item_word")
    best = named.groupBy("text_key").agg(F.min_by(row, order).alias("best"), F.sum("ids").alias("n_items"))
    own = docs.select(*keys, _key(F.col("text")).alias("_own"))
    return own.join(best, F.col("_own") == F.col("text_key")).select(*keys, "best.*", "n_items")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item, with their columns."""
    leaks = staged(overlaps(docs.select("text"), benchmark).select("text_key").distinct(), "leak-texts")
    rows = boxed(docs, own=_key(F.col("text")), bucket=F.pmod(F.xxhash64("text"), F.lit(BUCKETS)))
    # The bucket is of the key's text, so it is found again from a document with that text.
    marked = rows.select("own", "bucket").join(leaks, F.col("own") == F.col("text_key"), "left_semi").select(F.col("bucket").alias("leak")).distinct()
    marked = staged(marked, "leak-buckets")
    # At most BUCKETS numbers are broadcast; only documents of their buckets are compared by key.
    maybe = rows.join(F.broadcast(marked), F.col("bucket") == F.col("leak"), "left_semi")
    apart = rows.join(F.broadcast(marked), F.col("bucket") == F.col("leak"), "left_anti")
    kept = maybe.join(leaks, F.col("own") == F.col("text_key"), "left_anti")
    return unboxed(apart.select("_row").union(kept.select("_row")), docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat passages of the benchmark: doc_id, the item_id with most, where, and the number of items."""
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
