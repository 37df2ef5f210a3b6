"""Embedding whitening by the exact characteristic polynomial of the scatter matrix.

Entries become integers, ``floor(scale * c)``.  One pass adds up their products exactly; with the sums S and
the number n of vectors, ``n * sum(x x') - S S'`` is an integer matrix, ``n * n`` times the covariance.  Its
characteristic polynomial is computed modulo many primes by Hessenberg reduction, one prime in a row of a Spark
job, and put together by the Chinese remainder theorem.  The largest roots are isolated one by one in further
tasks, to 64 bits or more, and inverse iteration in long fixed-point numbers gives the unit eigenvectors.

Only tables of d x d numbers reach the driver or are sent to tasks (d: length of a vector), however many rows there are.

Vectors that are null, empty, or hold null or non-finite entries are left out.  All others must be of one length:
the commonest one (of several, the longest) is used, and vectors of other lengths are left out too.  Repeated rows
count as often as they stand.  Entries of ``2**53 / scale`` and more are an error.  Directions without any variance have no
component, so n equal vectors give no rows.  Equal eigenvalues share an eigenspace, of which some orthonormal basis is used.
``deviation`` is null where it is beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyframe.llm import polynomials

COMPONENTS = 32
SCALE = 64
# Integers are cut into limbs of 20 bits: 4,096 products of two limbs add up exactly in doubles.
LIMB, BLOCK = 20, 1 << 12
# A task hands its sums on before they could leave 64 bits.
FLUSH = 1 << 21
BITS = 64


def finite(vector: str) -> Column:
    """Whether a vector is there, is not empty and has finite entries only."""
    col = F.col(f"`{vector}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce((F.size(col) > 0) & ~F.exists(col, bad), F.lit(False))


def dimension(embeddings: DataFrame, vector: str) -> int:
    """The commonest length of usable vectors, 0 without any."""
    lengths = embeddings.where(finite(vector)).groupBy(F.size(F.col(f"`{vector}`")).alias("d")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return first[0]["d"] if first else 0


def usable(embeddings: DataFrame, vector: str, d: int) -> DataFrame:
    return embeddings.where(finite(vector) & (F.size(F.col(f"`{vector}`")) == d))


def integers(column: pa.Array, d: int, scale: int) -> np.ndarray:
    """``floor(scale * c)`` of all entries, one row for each vector."""
    flat = np.floor(scale * np.asarray(column.flatten(), np.float64))
    if len(flat) and np.abs(flat).max() >= 2.0**53:
        raise ValueError(f"Entries of vectors must be below 2**53 / {scale}")
    return flat.astype(np.int64).reshape(-1, d)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    if not len(x) or np.abs(x).max() < 1 << LIMB:
        return [x.astype(np.float64)]
    low = x & ((1 << LIMB) - 1)
    return [low.astype(np.float64), *_limbs((x - low) >> LIMB)]


def scatter_sums(vectors: DataFrame, vector: str, d: int, scale: int) -> list[list[int]]:
    """Exact sums of products of all entries, with a last entry of 1 added to every vector.

    So the last row has the sums of the entries, and ends with the number of vectors.
    """
    size = d + 1

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        rows = 0

        def given() -> Iterator[pa.RecordBatch]:
            i, j = np.triu_indices(size)
            for power, table in sums.items():
                # Products of two different limbs stand in both orders, so the table is symmetric.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), power, np.int32)), pa.array((i * size + j).astype(np.int64)), pa.array(table[i, j])],
                    ["power", "cell", "value"],
                )
            sums.clear()

        for batch in batches:
            whole = integers(batch.column(0), d, scale)
            for begin in range(0, len(whole), BLOCK):
                x = whole[begin : begin + BLOCK]
                limbs = _limbs(np.column_stack([x, np.ones(len(x), np.int64)]))
                for a, left in enumerate(limbs):
                    for b, right in enumerate(limbs):
                        table = sums.setdefault(a + b, np.zeros((size, size), np.int64))
                        table += (left.T @ right).astype(np.int64)
                rows += len(x)
                if rows >= FLUSH:
                    yield from given()
                    rows = 0
        yield from given()

    parts = vectors.select(vector).mapInArrow(of_task, "power int, cell long, value long")
    total = F.sum(F.col("value").cast("decimal(20,0)")).alias("value")
    out = [[0] * size for _ in range(size)]
    for r in parts.groupBy("power", "cell").agg(total).collect():
        i, j = divmod(r["cell"], size)
        out[i][j] += int(r["value"]) << (LIMB * r["power"])
        if i != j:
            out[j][i] = out[i][j]
    return out


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix), the leading one first, of a positive semidefinite integer matrix."""
    primes = polynomials.primes_for(2 * polynomials.coefficient_bound(matrix))
    cells = matrix.tolist()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array(cells, object)
        for batch in batches:
            at = batch.column(0)
            found = [polynomials.hessenberg_polynomial(own, primes[k]) for k in at.to_pylist()]
            yield pa.RecordBatch.from_arrays([at, pa.array(found, pa.list_(pa.int64()))], ["id", "residues"])

    tasks = min(len(primes), max(spark.sparkContext.defaultParallelism, len(primes) * len(matrix) // 4096))
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(of_task, "id long, residues array<long>").collect()
    rows.sort(key=lambda r: r["id"])
    return polynomials.chinese_remainder([r["residues"] for r in rows], primes)


def _precise_root(polynomial: list[int], rank: int, top: int) -> tuple[int, int, int]:
    """(root, bits, number): a root in steps of 2**-bits, to 60 leading bits or more, and how many share it."""
    bits = BITS
    while True:
        least, number = polynomials.isolate(polynomial, rank, top, bits)
        if least.bit_length() >= 60:
            # The middle of the last step.
            return 2 * least + 1, bits + 1, number
        bits *= 2


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors with entry sums ``sums``; unit ``vectors`` (columns) by falling ``eigenvalues``."""

    column: str
    scale: int
    d: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray

    def _parts(self, column: pa.Array) -> tuple[list, np.ndarray]:
        """Deviation and whitened vector of each row."""
        x = integers(column, self.d, self.scale)
        widest = self.n * (int(np.abs(x).max()) if len(x) else 0) + max(map(abs, self.sums), default=0)
        if widest * widest * self.d < 2**63:
            apart = self.n * x - np.array(self.sums, np.int64)
            deviation = (apart * apart).sum(axis=1).tolist()
        else:
            apart = self.n * x.astype(object) - np.array(self.sums, object)
            deviation = [int(v) if v < 2**63 else None for v in (apart * apart).sum(axis=1)]
            apart = np.array([[int(v) / self.n for v in row] for row in apart], np.float64).reshape(-1, self.d) * self.n
        return deviation, (apart.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.eigenvalues))

    def apply(self, embeddings: DataFrame) -> DataFrame:
        """All usable rows: their ``key`` column as it is, ``deviation`` and the ``whitened`` vector."""
        rows = usable(embeddings, self.column, self.d)

        @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
        def whiten(column: pa.Array) -> pa.Array:
            deviation, values = self._parts(column)
            k = values.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * k), pa.array(values.ravel()))
            return pa.StructArray.from_arrays([pa.array(deviation, pa.int64()), lists], ["deviation", "whitened"])

        # The struct is boxed, so that its two fields come from one call.
        boxed = rows.select(F.struct("*").alias("_row"), whiten(F.col(f"`{self.column}`")).alias("_white"))
        return boxed.select("_row", F.col("_white.deviation").alias("deviation"), F.col("_white.whitened").alias("whitened"))

    def identity_error(self, embeddings: DataFrame) -> float:
        """The largest entry of the covariance of the whitened rows minus the identity, from the rows themselves."""
        k = len(self.eigenvalues)

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k + 1, k + 1))
            for batch in batches:
                _, white = self._parts(batch.column(0))
                white = np.column_stack([white, np.ones(len(white))])
                total += white.T @ white
            cells = np.arange(total.size, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel())], ["cell", "value"])

        vectors = usable(embeddings, self.column, self.d).select(self.column)
        rows = vectors.mapInArrow(of_task, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
        table = np.zeros((k + 1) * (k + 1))
        for r in rows:
            table[r["cell"]] = r["value"]
        table = table.reshape(k + 1, k + 1) / self.n
        covariance = table[:k, :k] - np.outer(table[k, :k], table[k, :k])
        return float(np.abs(covariance - np.eye(k)).max()) if k else 0.0


def fit(embeddings: DataFrame, vector: str = "embedding", *, components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of all usable vectors; None where there is none or they do not vary."""
    spark = embeddings.sparkSession
    d = dimension(embeddings, vector)
    if not d:
        return None
    sums = scatter_sums(usable(embeddings, vector, d), vector, d, scale)
    n, first = sums[d][d], sums[d][:d]
    matrix = np.array([[n * sums[i][j] - first[i] * first[j] for j in range(d)] for i in range(d)], object)
    trace = sum(int(matrix[i, i]) for i in range(d))
    if not trace:
        return None
    polynomial = characteristic_polynomial(spark, matrix)
    top = 1 << trace.bit_length()
    wanted = min(components, polynomials.roots_above(polynomial, 0))

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, *_precise_root(polynomial, k, top)) for k in batch.column(0).to_pylist()]
            rank, root, bits, number = ([f[c] for f in found] for c in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rank, pa.int64()), pa.array(map(str, root), pa.string()), pa.array(bits, pa.int32()), pa.array(number, pa.int32())],
                ["rank", "root", "bits", "number"],
            )

    ranks = spark.range(1, wanted + 1, 1, wanted)
    found = sorted(ranks.mapInArrow(roots, "rank long, root string, bits int, number int").collect(), key=lambda r: r["rank"])
    spaces = {(r["root"], r["bits"]): r["number"] for r in found}
    listed = [(root, bits, number) for (root, bits), number in spaces.items()]
    cells = matrix.tolist()

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array(cells, object)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root, bits, number = listed[k]
                vectors = [v.tolist() for v in polynomials.null_vectors(own, int(root), bits, number)]
                yield pa.RecordBatch.from_arrays([pa.array([k] * number, pa.int64()), pa.array(range(number), pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], ["space", "n", "vector"])

    given = spark.range(0, len(listed), 1, len(listed)).mapInArrow(bases, "space long, n int, vector array<double>").collect()
    basis = {(r["space"], r["n"]): r["vector"] for r in given}
    columns, values, shares = [], [], []
    for space, (root, bits, number) in enumerate(listed):
        for k in range(min(number, wanted - len(columns))):
            columns.append(basis[space, k])
            values.append(int(root) / ((n * n) << bits))
            shares.append(int(root) / (trace << bits))
    return Whitening(vector, scale, d, n, tuple(first), np.array(values), np.array(shares), np.array(columns).T)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings: vec_id, component, n, deviation, whitened, explained, identity_error."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    white = fit(embeddings)
    if white is None:
        types = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
        return embeddings.where(F.lit(False)).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in types.items()])
    rows = white.apply(embeddings).select(F.col("_row.vec_id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.lit([float(x) for x in white.explained])
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(white.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(white.identity_error(embeddings)).alias("identity_error"),
    )
