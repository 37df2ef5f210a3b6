"""Toxicity: features against a plain count, held-out accuracy, and odd labels."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from keyframe.llm import toxicity

FOLDER = "/root/testdata/sf0.01"
LEARNT = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 3 != 1)


def measured(texts, lexicon=toxicity.NO_TERMS):
    rows = toxicity.features(pa.array(texts, pa.string()), np.full(len(texts), toxicity.FOLDS), lexicon)
    return [dict(zip(toxicity.FEATURES, r)) for r in rows]


def test_features_of_a_text():
    (one,) = measured(["You are an IDIOT, a m0ron!! Why? The day was fine and long until he came by and said trash"])
    words = 20
    assert one["words"] == pytest.approx(np.log1p(words))
    assert one["insult_density"] == pytest.approx(2 / words)
    assert one["disguised_insults"] == pytest.approx(1 / words)
    assert one["near_density"] == pytest.approx(2 / words)  # the first two are within five words of "you", "trash" is not
    assert one["address"] == pytest.approx(1 / words)
    assert one["loud_words"] == pytest.approx(1 / words)
    assert one["exclamations"] == pytest.approx(2 / words) and one["questions"] == pytest.approx(1 / words)
    assert one["runs"] == pytest.approx(1 / words)


def test_empty_and_odd_texts_have_features():
    for row in measured(["", None, " \n ", "!!!", "12 34", "\x00", "ß" * 10]):
        assert all(np.isfinite(v) for v in row.values())


def test_long_texts_count_in_pieces(monkeypatch):
    text = "you absolute moron walk away now " * 5000
    whole = measured([text, "short"])
    monkeypatch.setattr(toxicity, "PIECE", 4096)
    pieces = measured([text, "short"])
    for name in toxicity.FEATURES:
        assert pieces[0][name] == pytest.approx(whole[0][name], rel=1e-2), name
    assert pieces[1] == whole[1]


def test_held_out_accuracy(spark):
    docs = toxicity.op12_toxicity(spark, FOLDER)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = docs.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits, alarms = sum(p and y for p, y in judged), sum(p and not y for p, y in judged)
    assert hits >= 0.7 * sum(y for _, y in judged)
    assert alarms <= 0.03 * sum(not y for _, y in judged)


def test_learned_terms_find_words_that_no_list_has(spark):
    docs = [(k, f"the day was fine and long {'glorpish' if k % 4 == 0 else 'quiet'} garden number {k % 17}") for k in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k, _ in docs], "doc_id long, toxic int")
    scorer = toxicity.train(frame, labels)
    asked = spark.createDataFrame([(1, "the glorpish day was long and fine in garden 7"), (2, "the quiet day was long and fine in garden 7"), (3, "the glorping day was long and fine in garden 7")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in scorer.score(asked).collect()}
    assert found[1] >= 0.7 > 0.3 >= found[2]
    assert found[3] >= 0.7  # by the beginning of the word


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(LEARNT, 0), (3, 0)], 0.0), ([(LEARNT, 1)], 1.0), ([(LEARNT, None), (None, 1)], 0.0)])
def test_labels_of_one_kind_give_a_constant(spark, labels, score):
    frame = spark.createDataFrame([(LEARNT, "one"), (3, None), (3, None), (None, "two")], "doc_id long, text string")
    scorer = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r.score for r in scorer.score(frame).collect()] == [score] * 4


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    sample = toxicity.labelled_sample(docs, labels)
    ids = {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    assert sample.count() == len(ids & {r.doc_id for r in docs.collect()})
    assert toxicity.labelled_sample(docs, labels, 10).count() <= 10
