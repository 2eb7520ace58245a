"""Whole Arrow string columns cut into words and hashed, as numpy array work inside tasks.

A column is taken in slices of consecutive texts of bounded bytes (one longer text is a
slice of its own), so memory follows the slice and the longest text, not the batch. Hashes
are 64-bit polynomials over the bytes, read off prefix sums, with a final mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1024

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
U64 = np.uint64


def mix(x):
    """Finalizer that spreads every input bit over the result (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def numbers(n: int, seed: int):
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(BASE) + U64(seed))


def byte_class(inside) -> np.ndarray:
    return np.fromiter((bool(inside(b)) for b in range(256)), bool, 256)


# Words of the shared rule: ASCII digits and letters and everything from U+0080 on.
WORD_BYTES = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
# Words between ASCII white space.
INK_BYTES = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))


def byte_values(fold: bool) -> np.ndarray:
    """A random number per byte; with ``fold`` A-Z have those of a-z."""
    values = numbers(256, 7)
    if fold:
        values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


def slices(column, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS):
    """(first row, past-the-end row, bytes, offsets from 0) of bounded runs of texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        past = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        past = min(max(past, first + 1), first + rows, n)
        yield first, past, data[offsets[first]:offsets[past]], offsets[first:past + 1] - offsets[first]
        first = past


class Prefix:
    """Prefix sums of byte values times powers of the base: the hash of any byte range in O(1)."""

    inverse = pow(BASE, -1, 1 << 64)

    def __init__(self, data, values):
        with np.errstate(over="ignore"):
            power = np.full(len(data) + 1, U64(BASE))
            power[0] = 1
            power = np.multiply.accumulate(power)
            self.sums = np.zeros(len(data) + 1, U64)
            np.cumsum(values[data] * power[:-1], out=self.sums[1:])
            back = np.full(len(data) + 1, U64(self.inverse))
            back[0] = 1
            self.back = np.multiply.accumulate(back)

    def hashes(self, starts, ends):
        with np.errstate(over="ignore"):
            raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
            return mix(raw + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(data, offsets, inside):
    """Starts, ends and row of every maximal run of bytes of a class; runs end at row limits."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    mask = np.zeros(n + 2, bool)
    mask[1:-1] = inside[data]
    starts = np.flatnonzero(mask[1:-1] & (~mask[:-2] | edge[:-1]))
    ends = np.flatnonzero(mask[1:-1] & (~mask[2:] | edge[1:])) + 1
    return starts, ends, rows_of(starts, offsets)


def rows_of(positions, offsets):
    """Row that each position lies in; empty rows hold none."""
    return np.searchsorted(offsets, positions, side="right") - 1


def grams(hashes, rows, n: int):
    """Hash and index of the first word of every run of ``n`` words within a row."""
    if len(hashes) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    factors = numbers(n, 99) | U64(1)
    with np.errstate(over="ignore"):
        total = hashes[:len(hashes) - n + 1] * factors[0]
        for k in range(1, n):
            total += hashes[k:len(hashes) - n + 1 + k] * factors[k]
    whole = np.flatnonzero(rows[:len(rows) - n + 1] == rows[n - 1:])
    return mix(total[whole]), whole


def starts_of(rows, n: int):
    """Where each of ``n`` rows begins in a sorted list of row numbers, and one past the end."""
    return np.searchsorted(rows, np.arange(n + 1))


def sums(values, bounds):
    """Sum of the values of each row, given its bounds in them."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
