"""Words, hashed words and word shingles of whole texts, shared by the operators of this package.

A word is a longest run of bytes other than the six ASCII white-space bytes. Texts stay UTF-8 bytes
in the Arrow buffer they came in; a chunk of some documents is hashed by a few numpy passes, never
word by word. Hashes are 64 bits wide; two different words or shingles of one corpus share a hash
with a probability of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Bytes of text that are hashed together; one longer document is a chunk of its own.
CHUNK_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finishing step of a splitmix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """`n` pseudorandom 64-bit numbers that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed % (1 << 63)))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = numbers(1, 256)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_PLACES = numbers(2, 64) | np.uint64(1)
_STEP = int(numbers(3, 1)[0]) | 1
_BACK = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next chunk."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64)
        while len(known) < n:
            known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
        if n <= 8 * CHUNK_BYTES:
            _powers[base] = known
    return known[:n]


@dataclass
class Words:
    """The words of some neighbouring rows of a batch."""

    rows: range
    data: np.ndarray  # the bytes of the rows
    row_at: np.ndarray  # where each row begins in `data`, and the end
    starts: np.ndarray  # of each word in `data`
    ends: np.ndarray
    first: np.ndarray  # the first word of each row, and the end
    hashes: np.ndarray

    def of_row(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]:self.first[i + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for each `size` words of one row in text order, and where each row's begin.

        A row with fewer words has one that holds them all; one without words has none.
        """
        n, counts = len(self.hashes), self.counts
        total = np.zeros(n, np.uint64)
        for i in range(min(size, n)):
            total[:n - i] += self.hashes[i:] * _PLACES[i]
        left = np.repeat(self.first[1:], counts) - np.arange(n)
        whole = left >= size
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            own = self.of_row(i)
            total[self.first[i]] = (own * _PLACES[:len(own)]).sum() + np.uint64(len(own))
            whole[self.first[i]] = True
        made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        return mix(total[whole]), np.concatenate([[0], np.cumsum(made)])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins (a null is an empty text)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.empty(0, np.uint8), at
    return np.frombuffer(data, np.uint8), at


def row_chunks(at: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[range]:
    """Runs of neighbouring rows with about `size` bytes together."""
    n, low = len(at) - 1, 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + size, "right")) - 1)
        yield range(low, min(high, n))
        low = min(high, n)


def word_chunks(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The hashed words of a text column; `lower` reads A-Z as a-z."""
    data, at = buffers(column)
    table = _BYTE_LOWER if lower else _BYTE
    for rows in row_chunks(at):
        row_at = at[rows.start:rows.stop + 1] - at[rows.start]
        piece = data[at[rows.start]:at[rows.stop]]
        n = len(piece)
        inside = ~_SPACE[piece]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = row_at[(row_at > 0) & (row_at < n)]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[piece] * _powers_of(_STEP, n), out=sums[1:])
        hashes = mix((sums[stops] - sums[starts]) * _powers_of(_BACK, n)[starts])
        yield Words(rows, piece, row_at, starts, stops, np.searchsorted(starts, row_at), hashes)


def hash_of(values: np.ndarray) -> int:
    """One signed 64-bit hash for a row of numbers, which depends on their order."""
    if not len(values):
        return 0
    places = numbers(4, len(values)) | np.uint64(1)
    total = (mix(values.astype(np.uint64)) * places).sum() + np.uint64(len(values))
    return int(mix(total.reshape(1)).view(np.int64)[0])


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: str
) -> DataFrame:
    """Run `work` on every Arrow batch; it returns the new columns by name."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                arrays = [made[n] for n in names]
                yield pa.RecordBatch.from_arrays(
                    [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names)

    return df.mapInArrow(run, schema)
