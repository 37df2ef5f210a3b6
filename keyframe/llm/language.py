"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of labelled text accepts every substring of it.  A
document is parsed greedily with each automaton: a phrase is the longest match that
starts where the last phrase ended.  The fewer phrases a language needs, the more of the
document it has seen; the count is normalised to bits for each byte (a phrase costs the
logarithm of the labelled text's length) and the least wins.

Learning takes a bounded sample (``TRAIN_BYTES`` for each language, ``TRAIN_TOTAL`` for all
of them), prediction whole texts.  An automaton is one flat table (next state by state
and symbol), so many pieces of text take a step at once: texts are parsed in pieces of
``PIECE`` bytes, and a phrase ends where a piece ends.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing could be learned; ties go to the language that sorts first; the
score is how much shorter the best code is than the second (0 to 1).  Repeated rows get
equal results.  Rows without an id are never learned from.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import bounded_batches, documents, held_out
from keyframe.llm.words import SPACE, Texts, slices

TRAIN_BYTES = 48_000
TRAIN_TOTAL = 600_000
EXCERPT = 1_500
PIECE = 1_024
SLICE = 1 << 20  # bytes of text parsed at once
# Symbols of the automata: nothing (after a piece's end), unseen, white space, other ASCII signs, then letters and high bytes.
PAD, UNSEEN, BLANK, SIGN, FIRST = 0, 1, 2, 3, 4
_ENDED = 1 << 30  # set in a table entry whose step ends a phrase


@dataclass
class LanguageModel:
    """Names of languages, bits of a phrase of each, symbols by byte, and the edges of all automata.

    States of all languages are numbered through; ``roots`` are their first ones, ``states`` is their number.
    """

    names: list[str]
    bits: np.ndarray
    symbols: np.ndarray
    roots: np.ndarray
    states: int
    edges: np.ndarray  # (state, symbol, next state) in rows

    @cached_property
    def table(self) -> np.ndarray:
        """The entry for each state and symbol: the place of the next state's own entries, and whether a phrase ends.

        Some 20 to 30 times the size of the edges, so it is made where texts are parsed and never sent.
        """
        width = int(self.symbols.max()) + 1
        table = np.empty((self.states, width), np.int32)
        state, symbol, to = (self.edges[:, k].astype(np.int64) for k in range(3))
        for n, root in enumerate(self.roots):
            end = self.roots[n + 1] if n + 1 < len(self.roots) else self.states
            start = np.full(width, root * width | _ENDED, np.int32)  # a symbol that the language lacks is a phrase of its own
            own = state == root
            start[symbol[own]] = (to[own] * width) | _ENDED
            table[root:end] = start
        inner = ~np.isin(state, self.roots)  # from a start, every step begins a phrase
        table[state[inner], symbol[inner]] = to[inner] * width
        table[:, PAD] = np.arange(self.states, dtype=np.int32) * width
        return table.ravel()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "table"}


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``text``; state 0 is its start."""
    steps: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for sign in text:
        now = len(steps)
        steps.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and sign not in steps[at]:
            steps[at][sign] = now
            at = links[at]
        if at >= 0:
            to = steps[at][sign]
            if lengths[to] == lengths[at] + 1:
                links[now] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                links.append(links[to])
                lengths.append(lengths[at] + 1)
                while at >= 0 and steps[at].get(sign) == to:
                    steps[at][sign] = copy
                    at = links[at]
                links[to] = links[now] = copy
        last = now
    return steps


def _alphabet(texts: dict[str, bytes]) -> np.ndarray:
    symbols = np.full(256, UNSEEN, np.uint8)
    symbols[:128] = SIGN
    symbols[SPACE] = BLANK
    letters = [*range(ord("a"), ord("z") + 1)]
    high = sorted({b for text in texts.values() for b in set(text) if b >= 128})
    for n, byte in enumerate([*letters, *high]):
        symbols[byte] = FIRST + n
    symbols[ord("A") : ord("Z") + 1] = symbols[ord("a") : ord("z") + 1]
    return symbols


def build_model(texts: dict[str, bytes]) -> LanguageModel:
    """Automata of the labelled text of each language."""
    names = sorted(name for name, text in texts.items() if text)
    symbols = _alphabet(texts)
    found, roots, bits, base = [np.zeros((0, 3), np.int32)], [], [], 0
    for name in names:
        text = symbols[np.frombuffer(texts[name], np.uint8)]
        steps = suffix_automaton(text.tobytes())
        listed = np.fromiter((x for state, out in enumerate(steps) for sign, to in out.items() for x in (base + state, sign, base + to)), np.int32)
        found.append(listed.reshape(-1, 3))
        roots.append(base)
        bits.append(np.log2(len(text) + 1))
        base += len(steps)
    return LanguageModel(names, np.array(bits), symbols, np.array(roots, np.int32), base, np.concatenate(found))


def phrase_counts(model: LanguageModel, texts: Texts) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns), in a greedy parse of the whole text."""
    sizes = np.diff(texts.bounds)
    pieces = -(-sizes // PIECE)
    text = np.repeat(np.arange(len(sizes)), pieces)
    first = np.concatenate(([0], np.cumsum(pieces)))
    begin = texts.bounds[text] + (np.arange(first[-1]) - first[text]) * PIECE
    length = np.minimum(texts.bounds[text + 1] - begin, PIECE)
    langs = len(model.roots)
    symbols = model.symbols[texts.data].astype(np.int32)
    order = np.argsort(-length, kind="stable")  # so that at each step the pieces that go on stand in front
    start = begin[order]
    going = np.searchsorted(-length[order], -np.arange(PIECE), side="left")
    state = np.repeat((model.roots * np.int32(int(model.symbols.max()) + 1))[:, None], len(start), axis=1)
    # Where a new phrase begins, by byte of the slice: a piece's first byte always does.
    fresh = np.zeros((langs, len(symbols)), bool)
    fresh[:, begin] = True
    for step in range(int(length.max()) if len(length) else 0):
        n = going[step]
        entry = model.table.take(state[:, :n] + symbols.take(start[:n] + step))
        fresh[:, start[:n] + step] |= entry >= _ENDED
        state[:, :n] = entry & (_ENDED - 1)
    ends = np.empty_like(state)
    ends[:, order] = state
    counts = np.zeros((langs, len(sizes)))
    for lang in range(langs):
        marks = np.concatenate(([0], np.cumsum(fresh[lang], dtype=np.int64)))
        found = marks[begin + length] - marks[begin]
        _followed(model, symbols, begin, length, text, fresh[lang], marks, ends[lang], found)
        counts[lang] = np.bincount(text, found, len(sizes))
    return counts.T


def _followed(model, symbols, begin, length, text, fresh, marks, ends, found) -> None:
    """Correct the phrases ``found`` in pieces into which a phrase of the piece before reaches, in place."""
    todo = np.flatnonzero(text[1:] == text[:-1]) + 1
    state, at = ends[todo - 1], np.zeros(len(todo), np.int64)
    seen = np.zeros(len(todo), np.int64)
    alone, last = ends.copy(), {}
    while len(todo):
        entry = model.table.take(state + symbols.take(begin[todo] + at))
        state, new = entry & (_ENDED - 1), entry >= _ENDED
        seen += new
        met = new & fresh[begin[todo] + at]
        over = ~met & (at + 1 == length[todo])
        for_met, for_over = todo[met], todo[over]
        found[for_met] = seen[met] + marks[begin[for_met] + length[for_met]] - marks[begin[for_met] + at[met] + 1]
        found[for_over] = seen[over]
        own = np.concatenate((alone[for_met], state[over]))
        other = own != ends[np.concatenate((for_met, for_over))]
        last |= dict(zip(np.concatenate((for_met, for_over))[other].tolist(), own[other].tolist()))
        going = ~(met | over)
        todo, state, at, seen = todo[going], state[going], at[going] + 1, seen[going]
        if not len(todo) and last:
            # Pieces that end in another state than was thought: the next ones are followed into again.
            again = [(k + 1, own) for k, own in last.items() if k + 1 < len(text) and text[k + 1] == text[k]]
            ends[list(last)] = list(last.values())
            last = {}
            todo = np.array([k for k, _ in again], np.int64)
            state = np.array([own for _, own in again], np.int32)
            at, seen = np.zeros(len(todo), np.int64), np.zeros(len(todo), np.int64)


def best_languages(model: LanguageModel, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's best language, and its score."""
    code = phrase_counts(model, texts) * model.bits
    best = code.argmin(axis=1)
    ranked = np.sort(code, axis=1)
    if code.shape[1] > 1:
        score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-9)
    else:
        score = 1 - ranked[:, 0] / np.maximum(8.0 * np.diff(texts.bounds), ranked[:, 0])
    return best, np.clip(score, 0.0, 1.0)


def train(docs: DataFrame) -> LanguageModel:
    """Learn from text and lang of the documents that are not held out.

    Excerpts of documents chosen by a hash of their ids are gathered up to the bounds.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return build_model({})
    share = min(TRAIN_BYTES, TRAIN_TOTAL // len(totals))
    wanted = 3 * (share // EXCERPT + 8)
    order = F.xxhash64(F.col("doc_id"), F.lit("language"))
    odds = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, min(1.0, wanted / n))])
    chance = (F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30)))
    rows = (
        known.where(chance < odds[F.col("lang")])
        .select("lang", order.alias("order"), F.substring("text", 1, EXCERPT).alias("text"))
        .where(F.col("text").rlike(r"\p{L}"))
        .distinct()
        .collect()
    )
    texts: dict[str, bytearray] = {lang: bytearray() for lang in totals}
    for row in sorted(rows, key=lambda r: (r["order"], r["text"])):
        own = texts[row["lang"]]
        if len(own) < share:
            own += row["text"].encode()[: share - len(own)] + b"\n"
    return build_model({lang: bytes(text).lower() for lang, text in texts.items()})


def language(text: Column, model: LanguageModel, spark: SparkSession) -> Column:
    """A struct (lang_pred, score) for each whole text."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batch: pa.Array, lettered: pa.Array) -> pa.Array:
        model = shared.value
        names = np.array([*model.names, "und"], object)
        best, score = np.full(len(batch), len(model.names)), np.zeros(len(batch))
        if model.names:
            for start, stop in slices(batch, SLICE):
                best[start:stop], score[start:stop] = best_languages(model, Texts(batch[start:stop]))
            none = ~np.asarray(lettered.to_numpy(zero_copy_only=False), bool)
            best[none], score[none] = len(model.names), 0.0
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang_pred", "score"])

    # Told to be not deterministic, it is not computed again for each place where its result is used.
    return predict.asNondeterministic()(text, F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document: doc_id, held_out, lang_pred, score."""
    docs = documents(spark, sf_dir)
    found = language(F.col("text"), train(docs), spark)
    return docs.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
