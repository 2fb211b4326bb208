"""Array helpers for the operators that work inside Arrow batches.

Texts arrive as Arrow string arrays; words are found and hashed on the UTF-8 buffer of many
documents at once.  Work is cut into slices of about ``CHUNK_BYTES``, so memory depends on the
longest single text, never on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


class Words(NamedTuple):
    """Words of a slice of documents: byte positions, document number, hash."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows of about ``size`` bytes of text; nulls become empty texts."""
    for batch in batches:
        place = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(place).cast(pa.large_string()), "")
        batch = pa.RecordBatch.from_arrays(
            [texts if i == place else batch.column(i) for i in range(batch.num_columns)], names=batch.schema.names
        )
        if not batch.num_rows:
            continue
        total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a large-string array without nulls, and its offsets from zero."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if last == first:
        return np.empty(0, dtype=np.uint8), offsets - first
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last], offsets - first


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one running sum over the buffer."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    inner = (sums[ends] - sums[starts]) * down[starts]
    return mixed(inner + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(texts: pa.Array, gaps: np.ndarray = SPACE) -> Words:
    """Runs of bytes outside ``gaps`` (by default blank and tab to carriage return), document by document."""
    data, offsets = buffer_of(texts)
    solid = ~gaps[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    first[heads] = solid[heads]
    last[tails] = solid[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, offsets, starts, ends, doc, span_hashes(data, starts, ends))


def lower_ascii(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(texts)
