"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

For tokenizers that drop white space, lower the case and split letters, single digits and
other signs, as the 49k word vocabulary does: the count of a text is the sum over its
pre-tokens.  A stretch between white space that is plain ASCII is cut into these; one with
other bytes, an apostrophe or ``<`` (contractions, special tokens) is kept whole and left
to the tokenizer.

Tier one is a compact hash table of the ``FREQUENT`` most frequent pre-tokens and their
token counts, broadcast (``SLOTS`` places of 12 bytes, whatever the corpus).  Tier two is a table
of the same kind in each worker, filled with what the tokenizer says of the misses; an entry may
be replaced by another one that falls into its place, so it never grows.

The most frequent pre-tokens come from all documents: every task sends its
``PER_TASK`` most frequent ones.  Which ones they are affects speed only.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of special tokens
inside texts count as the tokenizer's default has it; repeated rows get equal results.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import documents
from keyframe.llm.words import EXACT, LOWER, SPACE, Texts, slices

FREQUENT = 1 << 18
PER_TASK = 1 << 15
SLOTS = 1 << 21
LONGEST = 64
TOKEN_LIMIT = 2_048


# Kinds of bytes: white space, letters, digits, other printable ASCII, and what only the tokenizer can cut.
_LETTER, _DIGIT, _SIGN, _WHOLE = 1, 2, 3, 4
KIND = np.full(256, _WHOLE, np.uint8)
KIND[SPACE] = 0
KIND[0x21:0x7F] = _SIGN
KIND[ord("0") : ord("9") + 1] = _DIGIT
KIND[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
KIND[[ord("'"), ord("<")]] = _WHOLE


def pre_tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each pre-token, whether it is whole, and where each text's begin."""
    starts, ends, first = texts.words()
    kind = KIND[texts.data]
    odd = np.concatenate(([0], np.cumsum(kind == _WHOLE)))
    whole = odd[ends] > odd[starts]
    if whole.any():
        mark = np.zeros(len(kind) + 1, np.int8)
        mark[starts[whole]] = 1
        mark[ends[whole]] -= 1
        kind[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)] = _WHOLE
    begins = np.zeros(len(kind), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins[starts] = True
    begins &= kind > 0
    stops = np.ones(len(kind), bool)
    stops[:-1] = begins[1:] | (kind[1:] == 0)
    stops[ends - 1] = True
    stops &= kind > 0
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    as_is = kind[at] == _WHOLE
    hashes = texts.hashes(at, to, LOWER)
    if as_is.any():
        hashes[as_is] = texts.hashes(at[as_is], to[as_is], EXACT)
    return at, to, hashes, as_is, np.searchsorted(at, texts.bounds)


class LengthTable:
    """Hash to token count; of two hashes that share a place the later one stays."""

    def __init__(self, slots: int = SLOTS):
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.keys = np.zeros(slots, np.uint64)
        self.counts = np.full(slots, -1, np.int32)

    def put(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        place = hashes >> self.shift
        # Last write wins for keys and counts alike, as both use the same order.
        self.keys[place] = hashes
        self.counts[place] = counts

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """Token counts; -1 for a miss."""
        place = hashes >> self.shift
        return np.where(self.keys.take(place) == hashes, self.counts.take(place), -1)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_lengths(tokenizer, pieces: list[str], whole: np.ndarray) -> np.ndarray:
    """Tokens of each pre-token: plain ones go to the model at once, whole ones through all steps."""
    out = np.zeros(len(pieces), np.int32)
    tokenize = tokenizer.model.tokenize
    for k in np.flatnonzero(~whole):
        out[k] = len(tokenize(pieces[k].lower()))
    rest = np.flatnonzero(whole)
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    out[rest] = [len(e) for e in encode([pieces[k] for k in rest], add_special_tokens=False)]
    return out


def _top(words: dict[bytes, int], most: int) -> dict[bytes, int]:
    return dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:most])


def frequent_words(texts: DataFrame, column: str) -> list[str]:
    """The most frequent pre-tokens of all texts, from the most frequent ones of every task."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                texts = Texts(batch.column(0)[start:stop])
                starts, ends, hashes, _, _ = pre_tokens(texts)
                short = ends - starts <= LONGEST
                starts, ends = starts[short], ends[short]
                _, at, times = np.unique(hashes[short], return_index=True, return_counts=True)
                data = texts.data.tobytes()
                for k in np.argsort(-times, kind="stable")[: 2 * PER_TASK]:
                    word = data[starts[at[k]] : ends[at[k]]]
                    counts[word] = counts.get(word, 0) + int(times[k])
            if len(counts) > 16 * PER_TASK:
                counts = _top(counts, 4 * PER_TASK)
        most = _top(counts, PER_TASK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in most], pa.string()), pa.array(list(most.values()), pa.int64())], ["word", "n"]
        )

    found = texts.select(column).mapInArrow(of_task, "word string, n long")
    rows = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    return [r["word"] for r in rows]


def length_table(words: list[str], tokenizer) -> LengthTable:
    """The table of these pre-tokens, the most frequent first (it keeps its place)."""
    table = LengthTable()
    if words:
        texts = Texts(pa.array(words, pa.string()))
        _, _, hashes, whole, first = pre_tokens(texts)
        assert (np.diff(first) == 1).all(), "a pre-token is one pre-token"
        table.put(hashes[::-1], encode_lengths(tokenizer, words, whole)[::-1])
    return table


_WORKER: dict = {}


def _tools(path: str):
    if path not in _WORKER:
        _WORKER[path] = (load_tokenizer(path), LengthTable())
    return _WORKER[path]


def count_tokens(texts: pa.Array, known: LengthTable, path: str) -> np.ndarray:
    """Tokens of each whole text."""
    tokenizer, cache = _tools(path)
    out = np.zeros(len(texts), np.int64)
    for begin, stop in slices(texts):
        own = Texts(texts[begin:stop])
        starts, ends, hashes, whole, first = pre_tokens(own)
        counts = known.get(hashes)
        misses = np.flatnonzero(counts < 0)
        counts[misses] = cache.get(hashes[misses])
        misses = misses[counts[misses] < 0]
        if len(misses):
            fresh, at, back = np.unique(hashes[misses], return_index=True, return_inverse=True)
            data = own.data.tobytes()
            at = misses[at]
            lengths = encode_lengths(tokenizer, [data[starts[k] : ends[k]].decode() for k in at], whole[at])
            counts[misses] = lengths[back]
            cache.put(fresh, lengths)
        sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        out[begin:stop] = sums[first[1:]] - sums[first[:-1]]
    return out


def token_counts(docs: DataFrame, column: str, path: str) -> Column:
    """A column with the number of tokens of each whole text of ``column`` of ``docs``."""
    known = length_table(frequent_words(docs, column), load_tokenizer(path))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.arrow_udf("long")
    def count(batch: pa.Array) -> pa.Array:
        return pa.array(count_tokens(batch, shared.value, path))

    return count(F.col(column))


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Bytes and tokens of every document: doc_id, n_bytes, n_tokens, over_limit."""
    docs = documents(spark, sf_dir)
    n_tokens = token_counts(docs, "text", tokenizer_path(tokenizer))
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), n_tokens.alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
