"""Hard negatives against brute force, whitening against numpy, exact spectra against fractions."""

import itertools
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from keyframe.llm import hard_negatives, polynomials, whitening
from tests.llm import samples


def _vectors(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    return [(r.vec_id, None if r.embedding is None else list(r.embedding), r.label) for r in rows]


@pytest.mark.parametrize("at", ["awkward", "small"])
def test_hard_negatives(spark, results, folder, small, at):
    want = samples.hard_negatives(_vectors(spark, {"awkward": folder, "small": small}[at]))
    assert want
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[n] for n in names) for r in results("op11_hard_negatives", at)) == want


def test_hard_negatives_in_many_shards_and_groups(spark, small, monkeypatch):
    for name, value in {"SHARD": 7, "GROUP": 6, "CLUSTER": 4, "PIVOTS": 3, "STEP": 3}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = hard_negatives.prepared(spark.read.parquet(f"{small}/embeddings.parquet").limit(120))
    given = [(r.vec_id, r.label, r.vector) for r in rows.collect()]
    found = hard_negatives.mine(rows, rows.where("vec_id % 3 = 0"), k=2, low=50).collect()
    score = lambda x, y: int(np.dot(x, y))
    want = []
    for a, label, x in given:
        if a % 3:
            continue
        ranked = sorted((-score(x, v), i, y) for i, y, v in given if i != a)
        for minus, p, _ in [r for r in ranked if r[2] == label][:2]:
            fits = [r for r in ranked if r[2] != label and -50 * minus <= -100 * r[0] <= -100 * minus]
            want += [(a, p, n + 1, i, -minus, -s) for n, (s, i, _) in enumerate(fits[:2])]
    assert sorted(map(tuple, found)) == sorted(want)


def test_lists_are_left_early():
    """Rows that cannot matter are not scored once the walk is certain."""
    import pyarrow as pa

    angles = np.linspace(0, np.pi, 4096)
    table = pa.table({"vec_id": np.arange(4096), "label": np.zeros(4096, np.int64), "vector": [[1e3 * math.cos(a), 1e3 * math.sin(a)] for a in angles]})
    shard = hard_negatives.Shard(table, 2)
    cluster = hard_negatives.Cluster(np.array([[1e3, 0.0], [1e3, 10.0]]), shard)
    seen = [rows for _, rows, _ in cluster.walk(lambda: np.array([9e5, 9e5]))]
    assert sum(map(len, seen)) < 4096
    assert {k for k, a in enumerate(angles) if math.cos(a) >= 0.9} <= set(np.concatenate(seen).tolist())


@pytest.mark.parametrize("at", ["awkward", "small"])
def test_whitening(spark, results, folder, small, at):
    given = _vectors(spark, {"awkward": folder, "small": small}[at])
    given = [(i, v) for i, v, _ in given if v and all(c is not None and math.isfinite(c) for c in v)]
    d = Counter(len(v) for _, v in given).most_common(1)[0][0]
    given = [(i, v) for i, v in given if len(v) == d]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in given], np.int64)
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = results("op13_whitening", at)
    k = min(32, d)
    assert len(rows) == n * k and {r.component for r in rows} == set(range(1, k + 1))
    assert {r.n for r in rows} == {n}
    deviations = Counter((i, v) for (i, _), v in zip(given, ((n * x - sums) ** 2).sum(axis=1).tolist()))
    assert Counter((r.vec_id, r.deviation) for r in rows) == Counter({key: k * c for key, c in deviations.items()})
    shares = {r.component: r.explained for r in rows}
    assert np.allclose([shares[c + 1] for c in range(k)], values[:k] / values.sum(), rtol=1e-9)
    assert {r.identity_error for r in rows}.pop() < 1e-9
    # Up to the sign of each component, the same for all rows.
    mine = defaultdict(list)
    for r in rows:
        mine[r.component].append(r.whitened)
    exact = (x - x.mean(axis=0)) @ vectors[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        own, want = sorted(mine[c + 1]), exact[:, c]
        assert np.allclose(own, sorted(want), atol=1e-7) or np.allclose(own, sorted(-want), atol=1e-7)


def test_no_variance_no_rows(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None)], "vec_id long, embedding array<double>")
    assert whitening.fit(frame) is None
    assert whitening.fit(frame.where("vec_id = 3")) is None


def test_limbs_add_up_exactly(spark):
    values = [[float(2**44 + 3), 0.25], [float(-(2**45) - 1), 7.0], [5.0, -3.5]]
    frame = spark.createDataFrame([(v,) for v in values], "embedding array<double>")
    whole = [[math.floor(64 * c) for c in v] + [1] for v in values]
    assert whitening.scatter_sums(frame, "embedding", 2, 64) == [[sum(r[i] * r[j] for r in whole) for j in range(3)] for i in range(3)]


def _determinant(matrix):
    m, out = [[Fraction(x) for x in row] for row in matrix], Fraction(1)
    for k in range(len(m)):
        pivot = next((i for i in range(k, len(m)) if m[i][k]), None)
        if pivot is None:
            return Fraction(0)
        if pivot != k:
            m[k], m[pivot], out = m[pivot], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            factor = m[i][k] / m[k][k]
            m[i] = [a - factor * b for a, b in zip(m[i], m[k])]
    return out


@pytest.mark.parametrize("seed,d", list(itertools.product(range(3), (1, 2, 5, 8))))
def test_characteristic_polynomial(spark, seed, d):
    half = np.random.default_rng(seed).integers(-50, 50, (d, max(1, d - seed))).astype(object)
    matrix = half.dot(half.T)
    polynomial = whitening.characteristic_polynomial(spark, matrix)
    for at in range(-d, d + 1):
        shifted = [[(at if i == j else 0) - int(matrix[i, j]) for j in range(d)] for i in range(d)]
        assert sum(c * at ** (d - k) for k, c in enumerate(polynomial)) == _determinant(shifted)


def test_equal_eigenvalues_share_a_basis():
    turn = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], object)
    matrix = turn.dot(np.diag(np.array([9, 9, 9, 4], object))).dot(turn.T)  # eigenvalues 36 (three times) and 16
    primes = polynomials.primes_for(2 * polynomials.coefficient_bound(matrix))
    polynomial = polynomials.chinese_remainder([polynomials.hessenberg_polynomial(matrix, p) for p in primes], primes)
    assert [polynomials.isolate(polynomial, k, 256, 8) for k in (1, 2, 3, 4)] == [(36 * 256 - 1, 3)] * 3 + [(16 * 256 - 1, 1)]
    basis = np.array(list(polynomials.null_vectors(matrix, 36 << 64, 64, 3)))
    assert np.allclose(basis @ basis.T, np.eye(3), atol=1e-14)
    assert np.allclose(basis @ matrix.astype(float), 36 * basis, atol=1e-12)


def test_close_eigenvalues_are_told_apart():
    # Two roots that differ by one part in 10**17, beyond what doubles can tell.
    matrix = np.array([[10**17 + 1, 0, 0], [0, 10**17, 0], [0, 0, 3]], object)
    primes = polynomials.primes_for(2 * polynomials.coefficient_bound(matrix))
    polynomial = polynomials.chinese_remainder([polynomials.hessenberg_polynomial(matrix, p) for p in primes], primes)
    first, number = polynomials.isolate(polynomial, 1, 1 << 60, 16)
    assert number == 1 and first + 1 == (10**17 + 1) << 16
    assert np.allclose(np.abs(list(polynomials.null_vectors(matrix, first + 1, 16, 1))[0]), [1, 0, 0])
