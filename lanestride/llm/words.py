"""Words of many texts as flat arrays inside Arrow tasks, packed strings, and the table of hot cells."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import mixed, span_hash

BLOCK_BYTES = 4 << 20  # text whose equal strings are sent once
CELL_LOAD = 1 << 13  # strings that one cell of the load table counts, on average
MOST_CELL_BITS = 26  # so the table of hot cells never has more than 8 MB
HOT = 1 << 18  # strings that may travel to one key
CODEC = "zstd"


def byte_table(*spans: tuple[int, int]) -> np.ndarray:
    """Which bytes lie in one of the closed spans."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low:high + 1] = True
    return table


class Words:
    """The words of consecutive texts: every run of bytes outside ``gaps``, never across two texts.

    ``code`` numbers equal words alike (an exact dictionary of these texts),
    ``hash`` is a 64-bit hash of each word, ``first`` the index of each text's
    first word (with the end appended), ``flat``/``at`` the words with one space
    after each and where each begins there.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, gaps: np.ndarray):
        inside = ~gaps[flat]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        start[heads] = inside[heads]
        self.begin = np.nonzero(start)[0]
        self.first = np.searchsorted(self.begin, offsets)
        number = np.cumsum(start, dtype=np.int32 if len(flat) < 1 << 30 else np.int64)[inside]
        letters = flat[inside]
        begins = np.nonzero(start[inside])[0]
        self.flat = np.full(len(letters) + len(self.begin), 32, np.uint8)
        number += np.arange(-1, len(letters) - 1, dtype=number.dtype)
        self.flat[number] = letters
        self.at = np.concatenate([begins, [len(letters)]]) + np.arange(len(self.begin) + 1)
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.begin), [None, pa.py_buffer(np.append(begins, len(letters)).astype(np.int64)), pa.py_buffer(letters)])
        encoded = text.dictionary_encode()
        self.code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = len(encoded.dictionary)
        spelled = np.frombuffer(encoded.dictionary.buffers()[1], np.int64)[:self.size + 1] if self.size else np.zeros(1, np.int64)
        if self.size:
            data = np.frombuffer(encoded.dictionary.buffers()[2], np.uint8) if encoded.dictionary.buffers()[2] else np.zeros(0, np.uint8)
            self.hash = span_hash(data[:spelled[-1]], spelled[:-1], spelled[1:])[self.code]
        else:
            self.hash = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.begin)

    def strings(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The bytes of ``count`` words from each ``first``, one string after the other, a space after each word."""
        a, b = self.at[first], self.at[first + count]
        return self.flat[spread(a, b - a)]


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (size[i] of them), one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def named(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, int]:
    """(dense number of each pair, how many): equal pairs and only those have equal numbers, in the pairs' order.

    While a pair and its place fit in a word, words are sorted; the result is the same otherwise.
    """
    size = len(left)
    if not size:
        return np.zeros(0, np.int64), 0
    bits, place = int(right.max()).bit_length(), size.bit_length()
    word = (left << bits) | right
    if int(left.max()).bit_length() + bits + place <= 63:
        ranked = np.sort((word << place) | np.arange(size))
        order = ranked & ((1 << place) - 1)
        ranked >>= place
    else:
        order = np.argsort(word, kind="stable")
        ranked = word[order]
    step = np.zeros(size, np.int64)
    np.cumsum(ranked[1:] != ranked[:-1], out=step[1:])
    out = np.empty(size, np.int64)
    out[order] = step
    return out, int(step[-1]) + 1


def pack(*arrays: np.ndarray) -> tuple[bytes, list[int]]:
    """(compressed arrays, the bytes of each)."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return pa.Codec(CODEC, compression_level=3).compress(b"".join(parts), asbytes=True), [len(p) for p in parts]


def unpack(data: bytes, sizes: list[int], *kinds: str) -> list[np.ndarray]:
    flat = pa.Codec(CODEC).decompress(data, sum(sizes), asbytes=True) if sum(sizes) else b""
    ends = np.cumsum(sizes).tolist()
    return [np.frombuffer(flat[e - n:e], kind) for e, n, kind in zip(ends, sizes, kinds, strict=True)]


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def cell_bits(strings: int) -> int:
    """Bits of the cells of a load table for about so many strings."""
    return min(MOST_CELL_BITS, max(4, (strings // CELL_LOAD).bit_length()))


def bucket_bits(size: int, bucket: int) -> int:
    return max(0, (-(-size // bucket) - 1).bit_length())


CELLS = "level int, part int, sizes array<int>, data binary"
PART_CELLS = 16  # bits of the cells whose counts travel in one row


def cell_rows(levels: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """For each level and part of the load table how many keys (64-bit hashes) fall into each cell, packed."""
    rows: tuple[list, ...] = ([], [], [], [])
    for level, keys in enumerate(levels):
        found, count = np.unique(keys >> np.uint64(64 - bits), return_counts=True)
        if not len(found):
            continue
        part = (found >> np.uint64(PART_CELLS)).astype(np.int64)
        edges = np.nonzero(np.diff(part, prepend=-1))[0]
        for a, b in zip(edges, np.append(edges[1:], len(part)), strict=True):
            data, sizes = pack((found[a:b] & np.uint64((1 << PART_CELLS) - 1)).astype("<u2"), count[a:b].astype("<u4"))
            for column, x in zip(rows, (level, int(part[a]), sizes, data), strict=True):
                column.append(x)
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["level", "part", "sizes", "data"])


def hot_cells(counts: DataFrame, levels: int, bits: int, limit: int) -> list[np.ndarray]:
    """A bit for each cell of each level that more than ``limit`` strings fall into.

    The table has a fixed size (8 MB a level at most), whatever the corpus; a key in a
    hot cell is only dealt more finely, so that a cell counts several keys together does no harm.
    """
    def over(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << PART_CELLS, np.int64)
        for batch in batches:
            for row in batch.select(["sizes", "data"]).to_pylist():
                cell, n = unpack(row["data"], row["sizes"], "<u2", "<u4")
                total[cell] += n
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                                          pa.array([np.packbits(total > limit, bitorder="little").tobytes()], pa.binary())], ["level", "part", "bits"])

    out = [np.zeros(max(1, (1 << bits) >> 3), np.uint8) for _ in range(levels)]
    for row in counts.groupBy("level", "part").applyInArrow(over, "level int, part int, bits binary").toLocalIterator():
        low = row["part"] << (PART_CELLS - 3)
        here = np.frombuffer(row["bits"], np.uint8)[:max(1, (1 << min(bits, PART_CELLS)) >> 3)]
        out[row["level"]][low:low + len(here)] = here
    return out


def is_hot(keys: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    cell = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return (table[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of what precedes and of its next word."""
    return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def batches_of(column: str, batch: pa.RecordBatch) -> Iterator[tuple[object, pa.RecordBatch]]:
    """The rows of a batch by the value of one column."""
    place = batch.schema.get_field_index(column)
    for value in batch.column(place).unique():
        yield value.as_py(), batch.filter(pc.equal(batch.column(place), value))
