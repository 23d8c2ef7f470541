"""Numpy helpers that run inside tasks on the bytes of an Arrow string column.

A word is a maximal run of bytes of one class. Words and word sequences get 64-bit polynomial (Rabin-Karp) hashes
from running sums: with ``S[i] = sum of x[j] * B**j for j < i`` the hash of ``x[i:j]`` is ``(S[j] - S[i]) * B**-i``
modulo 2**64, so every window of a batch costs a subtraction and a product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a public-domain generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def space_class() -> np.ndarray:
    """Word bytes: everything but blank and the control characters 9 to 13."""
    table = np.ones(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = False
    return table


def letter_digit_class() -> np.ndarray:
    """Word bytes: letters and digits, all bytes of characters beyond ASCII included."""
    table = np.zeros(256, bool)
    for first, last in ((48, 57), (65, 90), (97, 122), (128, 255)):
        table[first:last + 1] = True
    return table


def token_classes() -> np.ndarray:
    """1: letters and digits, 2: other visible characters, 0: blanks."""
    return np.where(letter_digit_class(), 1, np.where(space_class(), 2, 0)).astype(np.uint8)


def lower_table() -> np.ndarray:
    """Lower-case A to Z only."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), None, None

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up is None or len(self.up) < n:
            size = max(n, 1 << 16)
            tables = []
            for base in (self.base, self.inverse):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                tables.append(np.cumprod(table, dtype=np.uint64))
            self.up, self.down = tables
        return self.up[:n], self.down[:n]


def running(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers, dtype=np.uint64, out=sums[1:])
    return sums


def window_hashes(values: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Hash of each window of ``size`` values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    up, down = powers.upto(len(values) + 1)
    sums = running(values, up[:len(values)])
    return mix((sums[size:] - sums[:-size]) * down[:len(values) - size + 1])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def pieces(column: pa.Array, chunk_bytes: int = CHUNK_BYTES,
           max_rows: int = 1 << 30) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``chunk_bytes`` text: first row, bytes, offsets from 0. A longer text is one piece."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1
        last = min(max(last, row + 1), rows, row + max_rows)
        yield row, data[offsets[row]:offsets[last]], offsets[row:last + 1] - offsets[row]
        row = last


class Words:
    """Words of a piece: byte ranges, 64-bit hashes and, per document, the range of its words.

    ``is_word`` gives the class of each byte; 0 separates, a word is a run of one other class.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, powers: Powers):
        n = len(data)
        kind = np.zeros(n + 1, np.uint8)
        kind[:n] = is_word[data]
        inside = kind != 0
        begins, ends = inside.copy(), inside.copy()
        changes = kind[1:] != kind[:-1]
        begins[1:] &= changes
        ends[:-1] &= changes
        borders = offsets[(offsets > 0) & (offsets < n)]  # documents follow each other without a blank
        begins[borders] |= inside[borders]
        ends[borders - 1] |= inside[borders - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        up, down = powers.upto(n + 1)
        sums = running(data.astype(np.uint64) + np.uint64(1), up[:n])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, offsets)

    def grams(self, size: int, powers: Powers, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all sequences of ``size`` words inside one document, and the index of their first words."""
        if len(self.hash) < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        hashes = window_hashes(self.hash if not salt else mix(self.hash ^ np.uint64(salt)), size, powers)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero(owner[:len(hashes)] == owner[size - 1:])
        return hashes[at], at


def planes(values: np.ndarray) -> bytes:
    """Increasing integers as differences, byte plane by byte plane, which block compression shrinks well."""
    steps = np.diff(values, prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.int64)
