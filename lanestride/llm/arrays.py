"""Texts as flat byte arrays inside Arrow tasks: bounded slices, rolling hashes, span hashes."""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # text held as arrays at once, so that they stay in a core's cache; a longer single text is a slice of its own
KEPT_POWERS = 8 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)


def flat_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    kind = pa.large_binary()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = pc.fill_null(column.cast(kind), pa.scalar(b"", kind))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row runs of a batch with at most ``limit`` bytes of text (or one row), each with its bytes and offsets."""
    flat, offsets = flat_texts(batch.column(batch.schema.get_field_index(text)))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, batch.num_rows)
        yield batch.slice(low, high - low), flat[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def powers(count: int, base: np.uint64 = STEP) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; up to ``KEPT_POWERS`` from a table that this process keeps."""
    if count > KEPT_POWERS:
        return _powers(count, int(base))
    return _kept_powers(1 << max(0, count - 1).bit_length(), int(base))[:count]


def _powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=4)
def _kept_powers(count: int, base: int) -> np.ndarray:
    return _powers(count, base)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def span_hash(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of one flat array; equal bytes give equal hashes wherever they stand."""
    power = powers(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:len(flat)], out=total[1:])
    inverse = powers(len(flat) + 1, np.uint64(pow(int(STEP), -1, 1 << 64)))
    return mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each row, empty rows included."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
