"""Exact spectra of integer matrices: characteristic polynomial, real roots, eigenvectors.

Plain integers throughout, so no step rounds before the last one.  Every function works on one small
matrix or polynomial; :mod:`keyframe.llm.whitening` deals primes and roots to Spark tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np

# Products of two residues below 2**31 fit into 64-bit integers.
PRIME_BITS = 31


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2**32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (0, 1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes, from the largest below 2**31 on, whose product exceeds ``bound``."""
    found, product, n = [], 1, 2**PRIME_BITS - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def coefficient_bound(matrix: np.ndarray) -> int:
    """No coefficient of the polynomial of a positive semidefinite matrix is larger.

    The k-th one is a sum of products of k eigenvalues, so all of them together are at most
    (1 + trace / d) ** d, by the inequality of means.
    """
    d = len(matrix)
    return (2 + sum(int(matrix[i, i]) for i in range(d)) // max(d, 1)) ** d


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo ``p``, the leading one first.

    Similarity steps clear the matrix below its first subdiagonal; the polynomial then follows from
    those of its leading blocks.
    """
    d = len(matrix)
    h = np.array([[int(x) % p for x in row] for row in matrix], np.int64).reshape(d, d)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[pivot, m]] = h[[m, pivot]]
            h[:, [pivot, m]] = h[:, [m, pivot]]
        factor = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factor[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factor % p).sum(axis=1)) % p
    # Row k: polynomial of the leading k x k block, by rising powers.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        own = np.zeros(d + 1, np.int64)
        own[1:] = blocks[k - 1, :-1]
        weights, product = [int(h[k - 1, k - 1])], 1
        for i in range(1, k):
            product = product * int(h[k - i, k - i - 1]) % p
            weights.append(product * int(h[k - 1 - i, k - 1]) % p)
        terms = np.array(weights, np.int64)[:, None] * blocks[k - 1 :: -1][:k] % p
        blocks[k] = (own - terms.sum(axis=0)) % p
    return [int(x) for x in blocks[d, ::-1]]


def chinese_remainder(residues: Sequence[Sequence[int]], primes: Sequence[int]) -> list[int]:
    """The integers of least absolute value with these residues (one row for each prime)."""
    product = 1
    for p in primes:
        product *= p
    out = [0] * len(residues[0])
    for row, p in zip(residues, primes):
        rest = product // p
        unit = rest * pow(rest, -1, p)
        out = [(x + unit * r) % product for x, r in zip(out, row)]
    return [x - product if 2 * x > product else x for x in out]


def roots_above(polynomial: Sequence[int], at: int) -> int:
    """How many roots of a polynomial with only real roots exceed an integer.

    The signs of the coefficients after a shift change as often as there are positive roots,
    which is exact because all roots are real.
    """
    shifted = [int(c) for c in polynomial]
    if at:
        for end in range(len(shifted), 1, -1):
            carry = shifted[0]
            for k in range(1, end):
                carry = shifted[k] = shifted[k] + at * carry
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def scaled(polynomial: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are ``2**bits`` times as large."""
    return [int(c) << (bits * k) for k, c in enumerate(polynomial)]


def _value(polynomial: Sequence[int], at: int) -> int:
    out = 0
    for c in polynomial:
        out = out * at + c
    return out


def isolate(polynomial: Sequence[int], rank: int, top: int, bits: int) -> tuple[int, int]:
    """(least, number) of the roots that cannot be told from the ``rank``-th largest one.

    All roots are real and below ``top``.  The result is in steps of ``2**-bits``: the root is above
    ``least`` and at most ``least + 1``, and so are as many roots as ``number`` says.
    """
    fine = scaled(polynomial, bits)
    # Coarse steps first: each halves the interval and counts the roots beyond its middle.
    low, high = 0, top << bits
    above_low, above_high = roots_above(fine, 0), 0
    if rank > above_low:
        raise ValueError("there is no such positive root")
    while high - low > 1 and above_low - above_high > 1:
        middle = (low + high) // 2
        count = roots_above(fine, middle)
        if count >= rank:
            low, above_low = middle, count
        else:
            high, above_high = middle, count
    if above_low - above_high == 1:
        # One root is left: the sign of the value decides.
        sign_high = _value(fine, high)
        if sign_high == 0:
            return high - 1, 1
        while high - low > 1:
            middle = (low + high) // 2
            value = _value(fine, middle)
            if value == 0:
                return middle - 1, 1
            if (value > 0) == (sign_high > 0):
                high = middle
            else:
                low = middle
    return low, above_low - above_high


def null_vectors(matrix: np.ndarray, root: int, bits: int, number: int, guard: int = 128) -> Iterator[np.ndarray]:
    """``number`` orthonormal vectors that ``matrix`` multiplies by ``root / 2**bits``.

    Inverse iteration in fixed-point numbers: the shifted matrix is factored once, and each of three solves
    brings a start vector nearer to the null space by the ratio of the gap to the error of the root.
    """
    d = len(matrix)
    work = bits + guard
    one = 1 << work
    a = np.array([[int(x) << work for x in row] for row in matrix], object).reshape(d, d)
    for i in range(d):
        a[i, i] -= int(root) << (work - bits)
    order = np.arange(d)
    least = 1 << (guard // 2)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        for i in range(k + 1, d):
            if a[i, k]:
                factor = (a[i, k] << work) // a[k, k]
                a[i, k + 1 :] -= (factor * a[k, k + 1 :]) >> work
                a[i, k] = factor

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for i in range(1, d):
            x[i] -= int(np.dot(a[i, :i], x[:i])) >> work
        for i in range(d - 1, -1, -1):
            rest = x[i] - (int(np.dot(a[i, i + 1 :], x[i + 1 :])) >> work if i + 1 < d else 0)
            x[i] = (rest << work) // a[i, i]
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        largest = max(abs(int(v)) for v in x)
        if not largest:
            return x
        x = np.array([(int(v) << work) // largest for v in x], object)
        length = math.isqrt(sum(int(v) * int(v) for v in x))
        return np.array([(int(v) << work) // length for v in x], object)

    found: list[np.ndarray] = []

    def apart(x: np.ndarray) -> np.ndarray:
        for other in found:
            share = int(np.dot(x, other)) >> work
            x = x - np.array([(share * int(v)) >> work for v in other], object)
        return x

    for k in range(number):
        # Start vectors without pattern, the same on every machine.
        start = np.random.default_rng(k + 1).integers(-(2**30), 2**30, d)
        x = unit(apart(np.array([int(v) << (work - 30) for v in start], object)))
        for _ in range(3):
            x = unit(apart(solve(x)))
        found.append(unit(apart(x)))
        # As a quotient of two integers, each entry is rounded to a double only once.
        yield np.array([int(v) / one for v in found[-1]])
