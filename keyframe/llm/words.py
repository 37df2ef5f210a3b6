"""Words of whole texts as arrays: spans, hashes and runs of words, without a loop over words.

Every function works on one slice of an Arrow string column.  A slice holds whole
texts and about ``SLICE_BYTES`` of them (a longer text is a slice of its own), so
memory stays bounded whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
LEAST_POWERS = 1 << 18

# The bytes that separate words: space, tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_GOLDEN = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers (a bijection, so different values stay different)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SEEDS = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
# One random value per byte; upper-case A-Z get the values of a-z in LOWER.
EXACT = _SEEDS[:256].copy()
LOWER = EXACT.copy()
LOWER[ord("A") : ord("Z") + 1] = LOWER[ord("a") : ord("z") + 1]
PLACE = _SEEDS[256:]

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        # Kept as long as the worker lives, so not longer than its slices ask for.
        steps = np.full(max(n + n // 4, LEAST_POWERS), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


class Texts:
    """Bytes of several texts: ``data``, and text ``k`` is ``data[ends[k-1]:ends[k]]``."""

    def __init__(self, texts: pa.Array):
        kind = pa.large_string() if texts.type in (pa.string(), pa.large_string()) else pa.large_binary()
        texts = texts.cast(kind).fill_null("" if kind == pa.large_string() else b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = whole[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each word; ``first`` of the result splits words by text."""
        inside = ~space[self.data]
        filled = np.flatnonzero(np.diff(self.bounds))
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        before[self.bounds[filled]] = False
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[self.bounds[filled + 1] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(starts, self.bounds)
        return starts, ends, first

    def hashes(self, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = LOWER) -> np.ndarray:
        """A 64-bit hash of each span of bytes, the same wherever the span stands."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.data] * _powers(_ODD, n + 1)[:n], out=sums[1:])
        value = (sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_GOLDEN))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes each, one row at least."""
    sizes = np.asarray(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def runs(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each text, and where each text's runs start.

    A text of fewer words (but one at least) has one run: all its words.
    """
    n = len(hashes)
    counts = np.diff(first)
    each = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(each)))
    if not n:
        return np.zeros(0, np.uint64), starts
    value = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        value += hashes[j : j + len(value)] * PLACE[j]
    value = mix(value)
    text = np.repeat(np.arange(len(counts)), each)
    at = first[text] + (np.arange(starts[-1]) - starts[text])
    out = value[np.minimum(at, max(len(value) - 1, 0))] if len(value) else np.zeros(len(at), np.uint64)
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        own = hashes[first[t] : first[t + 1]]
        out[starts[t]] = mix(np.array([(own * PLACE[: len(own)]).sum(dtype=np.uint64) + PLACE[100 + len(own)]]))[0]
    return out, starts
