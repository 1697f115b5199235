"""Hashes of byte ranges, many at a time: the text side of the sketching operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # an odd word to multiply by
PRIME = (1 << 31) - 1  # a Mersenne prime: remainders are a mask, a shift and a sum
# Two primitive roots of it, so no power of them is 1 before the PRIME - 1st.
ROOTS = (7, 48271)
PIECE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def byte_table(seed: int) -> np.ndarray:
    """A random word for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE + np.uint64(seed))


def _folded(x: np.ndarray) -> np.ndarray:
    """Equal modulo PRIME, and 31 bits shorter, but never below 32 bits."""
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def _remainder(x: np.ndarray) -> np.ndarray:
    x = _folded(_folded(_folded(x)))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


@lru_cache(maxsize=8)
def _powers(base: int, upto: int) -> np.ndarray:
    found, step = np.ones(1, np.uint64), base
    while len(found) < upto:
        found = np.concatenate([found, _remainder(found * np.uint64(step))])
        step = step * step % PRIME
    return found.astype(np.uint32)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME, from a table that grows by doubling."""
    return _powers(base, 1 << max(20, int(n - 1).bit_length()))[:n]


@lru_cache(maxsize=16)
def _residues(seed: int) -> np.ndarray:
    """A random remainder for each byte value."""
    return (byte_table(seed) % np.uint64(PRIME - 1) + np.uint64(1)).astype(np.uint32)


class RangeHash:
    """62-bit hashes of any byte ranges of one buffer, equal for equal bytes, mixed to a word.

    Two polynomials modulo a prime.  (Modulo a power of two the signed sum of a
    Thue-Morse string vanishes under every odd base, so that such a string and
    its complement would agree.)
    """

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.sums, self.inverses = [], []
        for k, root in enumerate(ROOTS):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            terms = np.multiply(_residues(seed + 1000 * k)[data], powers(root, len(data)), dtype=np.uint64)
            np.cumsum(_folded(terms), out=sums[1:])  # below 2**32 each, so 2**32 of them fit
            self.sums.append(sums)
            self.inverses.append(powers(pow(root, -1, PRIME), len(data) + 1))

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        one, two = (_remainder(_folded(_folded(s[stop] - s[start])) * i[start]) for s, i in zip(self.sums, self.inverses))
        return mix((one << np.uint64(31) | two) + mix((stop - start).astype(np.uint64) * BASE))

    def every(self, width: int) -> np.ndarray:
        """A hash of 31 bits, mixed, of the ``width`` bytes from each place on; to choose by, not to tell strings apart."""
        sums = self.sums[0]
        return mix(_remainder(_folded(_folded(sums[width:] - sums[:-width])) * self.inverses[0][: len(sums) - width]))


def texts_as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes in one array, without a copy, and where each row starts and ends in it."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, so that work arrays stay small."""
    _, ends = texts_as_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
