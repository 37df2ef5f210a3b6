"""Toxicity: boosted trees over dense features of whole texts, with isotonic calibration.

Each text becomes a short vector: how dense words of a lexicon are (a fixed list, and terms learned from
the labels), how many of them stand near a word that addresses somebody, capitals, punctuation, and
disguised words (``1d10t``).  Gradient-boosted trees give a margin, which an isotonic regression on a fold
that the trees never saw turns into a probability.

* Learned terms are words and word beginnings of 4, 5 and 6 bytes.  One aggregate counts the toxic and the
  clean documents that hold each, by fold.  A training document sees weights of a term without its own
  fold, so the trees learn how far such weights can be trusted on new documents.
* At most ``SAMPLE`` labelled documents are learned from, those of the least hash of their id; the
  ``TERMS`` most telling terms are kept.  Everything else covers all documents.
* Texts over ``PIECE`` bytes are measured in pieces cut after a space; nearness is not seen across a cut.

Null and empty texts have a vector of zeros and so a score like all others.  Without labels of both kinds
the score is the share of toxic ones (0 without any label).  Repeated labels of one id count as toxic if
half of them or more do; null labels count for nothing, and a null id has no label.  Repeated rows get one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm.stage import documents, staged
from keyframe.llm.words import LOWER, PLACE, Texts, slices

SAMPLE = 1 << 16
TERMS = 1 << 12
FOLDS = 5
PIECE = 1 << 20
NEAR = 5
TREES, DEPTH = 20, 4
TOXIC_FROM = 0.7

# Words that insult or abuse, in English, German, French and Spanish.
INSULTS = (
    "arsehole asshole bastard bitch bullshit clown cretin crap damn disgusting dumb dumbass fool freak garbage "
    "idiot idiotic idiots imbecile jerk liar loser losers lunatic moron moronic morons nasty pathetic pig "
    "retard retarded scum scumbag shit shut slut stupid stupidity suck sucks trash ugly useless vermin whore worthless "
    "arschloch blöd depp dreck dumm dummkopf idioten scheiße schwein trottel versager "
    "abruti connard connasse crétin débile imbécile merde ordure salaud salope "
    "basura cabrón estúpido gilipollas imbécil mierda pendejo puta tonto"
).split()
# Words that address somebody.
ADDRESS = (
    "you your yours yourself yourselves u ur thou thee du dich dir dein deine deiner euch euer ihr tu te toi ton tes "
    "vous votre vos tú ti usted ustedes vosotros vos"
).split()
# What stands for which letter in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

FEATURES = (
    "words insults insult_density learned learned_density strongest hits near_address near_density address "
    "capitals loud_words exclamations questions runs punctuation digits disguised disguised_insults"
).split()


def _mask(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _mask("0123456789")
_LEET = _mask("".join(DISGUISES))
_BANG, _ASK = _mask("!"), _mask("?")
_PUNCTUATION = _mask("!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~")
# Words are letters and what may stand for one; all else separates them.
_APART = ~(_LETTER | _LEET | _DIGIT)
_PLAIN = LOWER.copy()
_PLAIN_OF = LOWER.copy()
for _given, _letter in DISGUISES.items():
    _PLAIN_OF[ord(_given)] = LOWER[ord(_letter)]
_STARTS = (4, 5, 6)


def _hash_words(words: list[str]) -> np.ndarray:
    texts = Texts(pa.array(words, pa.string()))
    return np.sort(texts.hashes(texts.bounds[:-1], texts.bounds[1:], _PLAIN))


_INSULTS, _ADDRESS = _hash_words(list(INSULTS)), _hash_words(list(ADDRESS))


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


@dataclass(frozen=True)
class Lexicon:
    """Learned terms as sorted hashes, with weights by fold left out; the last column leaves none out."""

    terms: np.ndarray
    weights: np.ndarray


NO_TERMS = Lexicon(np.zeros(0, np.uint64), np.zeros((0, FOLDS + 1)))


def _terms(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word number, hash) of all words and of the beginnings of the longer ones."""
    yield np.arange(len(starts)), texts.hashes(starts, ends, _PLAIN)
    for size in _STARTS:
        long = np.flatnonzero(ends - starts > size)
        yield long, texts.hashes(starts[long], starts[long] + size, _PLAIN) ^ PLACE[200 + size]


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts, long ones as several pieces, and the row of each."""
    texts = texts.cast(pa.large_string()).fill_null("")
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    rows = np.arange(len(texts))
    if not (sizes > PIECE).any():
        return texts, rows
    parts, owner = [], []
    for row in rows:
        if sizes[row] <= PIECE:
            parts.append(texts[row].as_py().encode())
            owner.append(row)
            continue
        body, at = texts[row].as_py().encode(), 0
        while at < len(body):
            end = min(len(body), at + PIECE)
            if end < len(body):
                space = body.rfind(b" ", at + 1, end)
                end = space + 1 if space > at else end
            parts.append(body[at:end])
            owner.append(row)
            at = end
    return pa.array(parts, pa.large_binary()), np.array(owner)


def _counts(texts: Texts, lexicon: Lexicon, fold: np.ndarray) -> np.ndarray:
    """What is counted in each text, before it is put in proportion: one column for each of ``_RAW``."""
    data, bounds = texts.data, texts.bounds
    starts, ends, first = texts.words(_APART)

    def by_text(per_word: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(per_word)))
        return sums[first[1:]] - sums[first[:-1]]

    def by_byte(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return sums

    classes = {n: by_byte(m[data]) for n, m in (("letter", _LETTER), ("upper", _UPPER), ("digit", _DIGIT), ("leet", _LEET))}
    texts_of = {n: s[bounds[1:]] - s[bounds[:-1]] for n, s in classes.items()}
    words_of = {n: s[ends] - s[starts] for n, s in classes.items()}
    plain = texts.hashes(starts, ends, _PLAIN)
    insult = _in(plain, _INSULTS)
    mixed = (words_of["letter"] > 0) & (words_of["leet"] > 0)
    unmasked = np.zeros(len(starts), bool)
    at = np.flatnonzero((words_of["leet"] > 0) & (ends - starts < 64))
    unmasked[at] = _in(texts.hashes(starts[at], ends[at], _PLAIN_OF), _INSULTS)
    unmasked &= ~insult
    address = _in(plain, _ADDRESS)
    word_text = np.repeat(np.arange(len(texts)), np.diff(first))
    # Weights of learned terms: the most telling of a word's terms counts.
    weight = np.zeros(len(starts))
    for number, value in _terms(texts, starts, ends):
        if len(lexicon.terms):
            place = np.minimum(np.searchsorted(lexicon.terms, value), len(lexicon.terms) - 1)
            known = lexicon.terms[place] == value
            number, place = number[known], place[known]
            weight[number] = np.maximum(weight[number], lexicon.weights[place, fold[word_text[number]]])
    strong = weight > 0
    strongest = np.zeros(len(texts))
    np.maximum.at(strongest, word_text[strong], weight[strong])
    bad = insult | unmasked | strong
    # A word is near an address if one stands within NEAR words of it in the same text.
    seen = np.concatenate(([0], np.cumsum(address)))
    low = np.maximum(np.arange(len(starts)) - NEAR, first[word_text]) if len(starts) else np.zeros(0, np.int64)
    high = np.minimum(np.arange(len(starts)) + NEAR + 1, first[word_text + 1]) if len(starts) else low
    near = bad & (seen[high] - seen[low] > 0)
    loud = (words_of["upper"] == ends - starts) & (ends - starts >= 3)
    marks = _PUNCTUATION[data]
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (_BANG | _ASK)[data[1:]] & (_BANG | _ASK)[data[:-1]]
    doubled[bounds[:-1][np.diff(bounds) > 0]] = False
    bytes_of = lambda mask: (lambda s: s[bounds[1:]] - s[bounds[:-1]])(by_byte(mask))
    return np.column_stack(
        [
            np.diff(first), by_text(insult), by_text(weight), strongest, by_text(strong), by_text(near), by_text(address),
            texts_of["letter"], texts_of["upper"], by_text(loud), bytes_of(_BANG[data]), bytes_of(_ASK[data]),
            bytes_of(doubled), bytes_of(marks), texts_of["digit"], by_text(mixed), by_text(unmasked), np.diff(bounds),
        ]
    )


_RAW = (
    "words insults learned strongest strong near address letters upper loud bang ask doubled marks digits mixed unmasked bytes"
).split()


def features(texts: pa.Array, folds: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` for each whole text; ``folds`` names the column of weights of each."""
    parts, owner = _cut(texts)
    raw = np.zeros((len(texts), len(_RAW)))
    for begin, stop in slices(parts):
        own, rows = Texts(parts[begin:stop]), owner[begin:stop]
        counted = _counts(own, lexicon, folds[rows])
        best = counted[:, 3].copy()
        counted[:, 3] = 0
        np.add.at(raw, rows, counted)
        np.maximum.at(raw[:, 3], rows, best)
    c = dict(zip(_RAW, raw.T))
    words, letters, size = np.maximum(c["words"], 1), np.maximum(c["letters"], 1), np.maximum(c["bytes"], 1)
    return np.column_stack(
        [
            np.log1p(c["words"]), np.log1p(c["insults"]), c["insults"] / words, np.log1p(c["learned"]), c["learned"] / words,
            c["strongest"], np.log1p(c["strong"]), np.log1p(c["near"]), c["near"] / words, c["address"] / words,
            c["upper"] / letters, c["loud"] / words, c["bang"] / words, c["ask"] / words, c["doubled"] / words,
            c["marks"] / size, c["digits"] / size, c["mixed"] / words, c["unmasked"] / words,
        ]
    )


def _vectors(rows: list[np.ndarray] | np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows, np.float64)
    offsets = np.arange(len(flat) + 1, dtype=np.int32) * len(FEATURES)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))


def learned_terms(sample: DataFrame) -> Lexicon:
    """The terms that tell toxic documents from clean ones best, of (text, toxic, fold)."""
    cells = 2 * FOLDS

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = np.asarray(batch.column(1), np.int64) * FOLDS + np.asarray(batch.column(2), np.int64)
            parts, owner = _cut(batch.column(0))
            for begin, stop in slices(parts):
                texts, rows = Texts(parts[begin:stop]), owner[begin:stop]
                starts, ends, first = texts.words(_APART)
                text = np.repeat(rows, np.diff(first))
                held = [np.unique(np.stack([v, text[n].astype(np.uint64)]), axis=1) for n, v in _terms(texts, starts, ends)]
                term, row = np.concatenate(held, axis=1) if held else np.zeros((2, 0), np.uint64)
                names, back = np.unique(term, return_inverse=True)
                table = np.zeros((len(names), cells), np.int32)
                np.add.at(table, (back, kind[row.astype(np.int64)]), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), *[pa.array(table[:, k]) for k in range(cells)]],
                    ["term", *[f"c{k}" for k in range(cells)]],
                )

    schema = "term long, " + ", ".join(f"c{k} int" for k in range(cells))
    counted = sample.select("text", "toxic", "fold").mapInArrow(of_task, schema)
    counted = counted.groupBy("term").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(cells)])
    docs = sample.groupBy("toxic", "fold").count().collect()
    size = np.zeros(cells)
    for r in docs:
        size[r["toxic"] * FOLDS + r["fold"]] += r["count"]
    n_clean, n_toxic = size[:FOLDS].sum(), size[FOLDS:].sum()
    if not n_clean or not n_toxic:
        return NO_TERMS
    clean = sum(F.col(f"c{k}") for k in range(FOLDS))
    toxic = sum(F.col(f"c{k}") for k in range(FOLDS, cells))
    # How far the toxic documents are above what the clean ones let expect, in deviations.
    expected = (clean + 1) * (n_toxic / n_clean)
    surplus = (toxic - expected) / F.sqrt(expected + 1)
    best = counted.where((toxic >= 2) & (surplus > 1)).orderBy(F.desc(surplus), "term").limit(TERMS).collect()
    table = np.array([r[1:] for r in best], np.float64).reshape(-1, cells)
    weights = []
    for left_out in [*range(FOLDS), None]:
        kept = [f for f in range(FOLDS) if f != left_out]
        n0, n1 = size[kept].sum(), size[[FOLDS + f for f in kept]].sum()
        c0, c1 = table[:, kept].sum(axis=1), table[:, [FOLDS + f for f in kept]].sum(axis=1)
        odds = np.log((c1 + 0.1) / max(n1, 1)) - np.log((c0 + 0.1) / max(n0, 1))
        weights.append(np.where(c1 >= 2, np.maximum(odds - 1.0, 0.0), 0.0))
    terms = np.array([r["term"] for r in best], np.int64).view(np.uint64)
    order = np.argsort(terms)
    return Lexicon(terms[order], np.column_stack(weights)[order])


def is_held_out(doc_id) -> "F.Column":
    """Whether a document belongs to the third that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(text, toxic, fold) of at most ``most`` labelled documents that are not held out."""
    by_id = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.avg("toxic").alias("share"))
    learn = by_id.where(~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    learn = learn.select(
        F.col("doc_id").alias("_id"),
        (F.col("share") >= 0.5).cast("int").alias("toxic"),
        F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"),
    )
    # The sample has at most ``most`` rows of 16 bytes, so it may be broadcast at any size of the corpus.
    found = docs.select("doc_id", "text").join(F.broadcast(learn), F.col("doc_id") == F.col("_id"))
    return found.select("text", "toxic", "fold")


@dataclass(frozen=True)
class Scorer:
    """What was learned: a lexicon, trees and a calibration, or a constant where labels do not tell."""

    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    constant: float

    def _described(self, rows: DataFrame, fold) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(self.lexicon)

        @F.arrow_udf("array<double>")
        def measure(texts: pa.Array, folds: pa.Array) -> pa.Array:
            return _vectors(features(texts, np.asarray(folds, np.int64), shared.value))

        return rows.select("*", array_to_vector(measure("text", fold)).alias("features"))

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with a column ``text`` and none of ``features`` or ``margin``) and their ``score``."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.constant))
        margin = _margins(self.trees, self._described(rows, F.lit(FOLDS)))
        out = self.calibration.transform(margin).withColumn("score", F.col("calibrated"))
        return out.select(*rows.columns, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))


def _margins(trees, described: DataFrame) -> DataFrame:
    found = trees.transform(described)
    return found.withColumn("margin", vector_to_array("rawPrediction")[1])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Scorer:
    """Learn from the labelled documents that are not held out."""
    sample = staged(labelled_sample(docs, labels, most), "toxicity-sample")
    tuning = FOLDS - 1
    seen = {(r["toxic"], r["tune"]): r["count"] for r in sample.groupBy("toxic", (F.col("fold") == tuning).alias("tune")).count().collect()}
    total = sum(seen.values())
    toxic = seen.get((1, False), 0) + seen.get((1, True), 0)
    share = toxic / total if total else 0.0
    if not seen.get((1, False)) or not seen.get((0, False)):
        return Scorer(NO_TERMS, None, None, share)
    lexicon = learned_terms(sample)
    draft = Scorer(lexicon, None, None, share)
    measured = staged(draft._described(sample, F.col("fold")).select("features", F.col("toxic").cast("double").alias("toxic"), "fold"), "toxicity-features")
    classifier = GBTClassifier(
        featuresCol="features", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, maxBins=64,
        minInstancesPerNode=3, seed=7,
    )
    trees = classifier.fit(measured.where(F.col("fold") != tuning))
    # Both kinds must be among the rows for calibration; in tiny samples all rows calibrate.
    apart = seen.get((1, True)) and seen.get((0, True))
    tune = measured.where(F.col("fold") == tuning) if apart else measured
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="toxic", predictionCol="calibrated")
    calibration = isotonic.fit(_margins(trees, tune).select("margin", "toxic"))
    return Scorer(lexicon, trees, calibration, share)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document: doc_id, held_out, score, predicted."""
    docs = documents(spark, sf_dir)
    scorer = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = scorer.score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )
