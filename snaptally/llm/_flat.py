"""Texts of an Arrow batch as one flat byte array, and vectorised helpers on it.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. UTF-8 never uses
those bytes inside a longer character, so this equals ``[^\\x20\\x09-\\x0D]+`` on
the code points. All hashes are 64 bits with fixed seeds: the same bytes give the
same hash in every task, so no table of names has to be shared.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  #: texts worked on at once; a longer single text is a chunk of its own

_U = np.uint64
_B = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_B_INV = pow(_B, -1, 1 << 64)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (splitmix64 finaliser)."""
    x = np.asarray(x).astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def mix2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit value of an ordered pair."""
    return mix(mix(a) * _U(3) + np.asarray(b).astype(_U))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))

def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i <= n. One table per process: functions
    sent by value have globals of their own, and a worker gets new ones per task."""
    held = getattr(sys, "_snaptally_powers", None)
    if held is None or len(held[0]) <= n:
        held = []
        for base in (_B, _B_INV):
            out = np.full(max(n + 1, 1 << 16), base, dtype=_U)
            out[0] = 1
            held.append(np.multiply.accumulate(out))
        if n <= 8 * CHUNK_BYTES:  # a single very long text needs a larger one, but not for long
            sys._snaptally_powers = held
    return held[0], held[1]


def release() -> None:
    """Give memory of finished work back to the system: a worker process lives on
    between tasks, and its neighbours need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(work):
    """A task's generator that gives memory back when nothing of it is held any more."""

    def run(batches):
        yield from work(batches)
        release()

    return run


class Prefix:
    """Hashes of any span of a sequence of 64-bit values in constant time each.

    The hash of ``values[a:b]`` depends on the values and the length only.
    """

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values))
        self.sums = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (np.asarray(ends) - np.asarray(starts)).astype(_U) * _U(0xA24BAED4963EE407))

    def windows(self, n: int) -> np.ndarray:
        """Hashes of all spans of n values, by start."""
        m = len(self.sums) - n
        if m <= 0:
            return np.zeros(0, dtype=_U)
        raw = (self.sums[n:] - self.sums[:m]) * self.down[:m]
        return mix(raw + _U((n * 0xA24BAED4963EE407) % (1 << 64)))


class Texts:
    """``data``: the bytes of all texts; text i is ``data[offsets[i]:offsets[i+1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """The text number of every byte."""
        return np.repeat(np.arange(len(self), dtype=np.int32), self.lengths)

    def counts(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def words(self) -> Words:
        inside = ~SEPARATOR[self.data]
        at_start = np.zeros(len(self.data) + 1, dtype=bool)
        at_start[self.offsets] = True
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | at_start[:-1]))
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | at_start[1:])) + 1
        return Words(starts, ends, np.searchsorted(starts, self.offsets))


class Words:
    """Byte spans of words; those of text i are ``first[i]:first[i+1]``."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
        self.starts, self.ends, self.first = starts, ends, first

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.counts)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return Prefix(BYTE_VALUE[data]).spans(self.starts, self.ends)


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=width, count=len(column) + 1, offset=column.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return Texts(data, offsets - offsets[0])


def chunks(batches, column: str, limit: int = CHUNK_BYTES):
    """Row slices of Arrow batches with at most ``limit`` bytes in the column, one row at least."""
    yield from parts(batches, lambda batch: texts_of(batch.column(column)).lengths, limit)


def parts(batches, weight, limit: int):
    """Row slices of Arrow batches whose ``weight(batch)`` (a number for each row)
    sums to at most ``limit``, one row at least."""
    release()
    for batch in batches:
        total, start = 0, 0
        for i, n in enumerate(weight(batch).tolist() if batch.num_rows else []):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows:
            yield batch.slice(start)
    release()


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of numpy arrays or lists, unsigned hashes reinterpreted as signed."""
    arrays = []
    for x, field in zip(columns, schema, strict=True):
        if isinstance(x, np.ndarray) and x.dtype == np.uint64:
            x = x.view(np.int64)
        arrays.append(x if isinstance(x, pa.Array) else pa.array(x, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
