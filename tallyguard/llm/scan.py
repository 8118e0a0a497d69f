"""Whole texts as bytes inside tasks: words, lines and their hashes without a Python loop.

An Arrow text column is one buffer of UTF-8 bytes with row bounds. Working on that buffer
with numpy costs a few nanoseconds a byte, and memory stays bounded because a batch is
walked in slices of about ``SLICE`` bytes (a single longer text is a slice of its own).
Null texts are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

SLICE = 1 << 18

# The bytes 0x20 and 0x09 to 0x0D separate words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection, so different values stay different)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def seeded(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit values for a seed."""
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([seed], dtype=np.uint64)))


class Rolling:
    """Quick hashes of any substrings of a buffer from one running sum (a polynomial modulo 2^64).

    Every byte stands for a 64-bit value drawn by ``seed``. Equal strings have equal hashes, but
    there are pairs of different strings that share theirs whatever the seed: good for dealing
    strings out, not for telling them apart.
    """

    def __init__(self, seed: int = 1):
        self.values = seeded(seed, 256)
        self.base = int(mix(np.array([seed + 77], dtype=np.uint64))[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums, one longer than the data; ``of`` needs them."""
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:], dtype=np.uint64)
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


_PRIME = np.uint64((1 << 31) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    """The same number modulo the prime, in fewer bits."""
    return (x & _PRIME) + (x >> np.uint64(31))


class Hasher:
    """Hashes that tell substrings of a buffer apart: two polynomials modulo the prime 2^31 - 1.

    Their bases and the values of the bytes are drawn by ``seed``. Two different strings of n
    bytes share both with a chance of at most (n / 2^31)^2, some 2^-62 for nearly all, as
    powers of a base do not run into each other modulo a prime. With ``fold`` the letters A to Z
    stand for a to z.
    """

    def __init__(self, seed: int = 1, fold: bool = False):
        prime = int(_PRIME)
        values = (seeded(seed, 512) % np.uint64(prime - 1) + np.uint64(1)).reshape(2, 256)
        self.values = values[:, LOWER] if fold else values
        self.bases = [int(x) % (prime - 2) + 2 for x in seeded(seed + 77, 2)]
        self.inverses = [pow(b, -1, prime) for b in self.bases]
        self.up = self.down = np.ones((2, 1), dtype=np.uint64)

    def _grow(self, n: int) -> None:
        while self.up.shape[1] < n:
            size = self.up.shape[1]
            for name, bases in (("up", self.bases), ("down", self.inverses)):
                known = getattr(self, name)
                step = np.array([[pow(b, size, int(_PRIME))] for b in bases], dtype=np.uint64)
                setattr(self, name, np.concatenate((known, known * step % _PRIME), axis=1))

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Running sums, a row for each polynomial and one longer than the data; ``of`` needs them."""
        self._grow(len(data) + 1)
        out = np.zeros((2, len(data) + 1), dtype=np.uint64)
        for i in range(2):
            # Less than 2^32 each: sums of up to 2^31 bytes stay within 64 bits.
            np.cumsum(_reduced(self.values[i][data] * self.up[i, : len(data)]), out=out[i, 1:], dtype=np.uint64)
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each data[start:end]; equal strings have equal hashes anywhere."""
        one, two = (_reduced(_reduced(sums[i][end] - sums[i][start])) * self.down[i][start] % _PRIME for i in range(2))
        return mix((one << np.uint64(31) | two) + mix((end - start).astype(np.uint64)))


def coded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of substrings, equal for equal strings alone, and the strings in the order of the codes.

    The substrings come in order and do not overlap. Nothing is hashed that is not compared.
    """
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    bounds = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    found = pa.Array.from_buffers(pa.large_binary(), len(start), buffers).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def string_hashes(strings: pa.Array) -> np.ndarray:
    """Hashes of whole strings, the same in every batch (SipHash, keyed)."""
    if not len(strings):
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(strings.to_numpy(zero_copy_only=False), categorize=False)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the bounds of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if len(column) == 0 or bounds is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    bounds = np.frombuffer(bounds, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``size`` bytes, or one longer row."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end
        row = end


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a row bound."""
    if not len(inside):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``."""
    start, end = runs(~SPACE[data], bounds)
    return start, end, np.searchsorted(bounds, start, side="right") - 1


def per_row(row: np.ndarray, rows: int, weight: np.ndarray | None = None) -> np.ndarray:
    """How many items, or what sum of weights, each row has."""
    return np.bincount(row, weights=weight, minlength=rows)


def firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the items by the keys (first key first), and where it meets a new one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for key in keys:
            sorted_key = key[order]
            new[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, new
