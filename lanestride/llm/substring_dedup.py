"""Repeated byte strings removed by interval expansion on Burrows-Wheeler transforms of candidate segments."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import STEP, mixed, slices, span_hash
from lanestride.session import stage

LENGTH = 50  # bytes of a repeated string
ANCHORS = (16, 32, 50)  # bytes whose hash places a string: at first, for strings of a hot anchor, and for those of a hot anchor even then
KINDS = (0, 3, 4)  # of replies on the anchors of each level
BLOCK_BYTES = 4 << 20  # whole documents held and sent together
BUCKET_BYTES = 4 << 20  # corpus bytes whose segments one index task receives, about
CHUNK = (1 << 16) - 64  # starts looked at together; their arrays stay in a core's cache
HOT_SEGMENTS = 1 << 14  # segments of one anchor, distinct inside their blocks, above which its strings are dealt by themselves
PART_BITS = 4  # a bucket is indexed in so many bits' parts, one after the other
POSITION_BITS = 16  # a place among the bytes that are looked at together
SALT = np.uint64(0xA0761D6478BD642F)
NOBODY = np.iinfo(np.int64).max


def packed(values: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(np.ascontiguousarray(values).tobytes(), asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data, size, asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, sizes, data): runs of whole documents of about 4 MB of UTF-8, compressed; null texts are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, offsets in slices(batch, "text", block_bytes):
                ids = pa.ListArray.from_arrays(np.array([0, part.num_rows], np.int32), part.column(0))
                sizes = pa.ListArray.from_arrays(np.array([0, part.num_rows], np.int32), pa.array(np.diff(offsets)))
                data = pa.array([packed(flat)], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, sizes, data], ["ids", "sizes", "data"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "ids array<long>, sizes array<long>, data binary")
    return stage(rows.withColumn("block", F.monotonically_increasing_id()))


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, bytes) of a block."""
    sizes = np.asarray(row["sizes"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = unpacked(row["data"], int(offsets[-1]))
    return np.asarray(row["ids"], np.int64), offsets, flat


def rolled(flat: np.ndarray, width: int) -> np.ndarray:
    """A 32-bit value of each window of ``width`` (a power of two) bytes, good in its upper half; only tells which window of several is the anchor."""
    level, span = flat.astype(np.uint32), 1
    level += np.uint32(1)
    while span < width:
        level = level[:-span] * np.uint32(pow(int(STEP), span, 1 << 32)) + level[span:]
        span *= 2
    level ^= level >> np.uint32(15)
    level *= np.uint32(0x2C1B3C6D)
    return level


def window_values(flat: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the ``width`` bytes (8 at least) from each place."""
    words = np.ndarray(len(flat) - 7, "<u8", np.ascontiguousarray(flat), strides=(1,))
    value = np.full(len(at), width, np.uint64)
    for i in [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]:
        value = mixed(value * STEP + words[at + i])
    return mixed(value * SALT)


def anchored(flat: np.ndarray, starts: np.ndarray, level: int, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first start, number of starts, 48-bit anchor value) of maximal runs of sorted starts with one anchor.

    The anchor of a start is the window of ``ANCHORS[level]`` bytes inside the
    ``length`` bytes from there with the least hash, the leftmost of equals; so
    equal strings have equal anchors at equal places, wherever they stand.
    Values of different levels differ in their last two bits.  ``flat`` has
    at most ``1 << POSITION_BITS`` bytes.
    """
    anchor = ANCHORS[level]
    width = length - anchor + 1
    at = starts
    if width > 1:
        low_bits = np.uint32((1 << POSITION_BITS) - 1)
        least = rolled(flat, anchor)
        least &= ~low_bits
        least |= np.arange(len(least), dtype=np.uint32)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            rest = width - span
            least = np.minimum(least[:-rest], least[rest:])
        at = least[starts] & low_bits
    begin = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] - starts[:-1] > 1)]))[0]
    return begin, np.diff(np.append(begin, len(starts))), (window_values(flat, at[begin].astype(np.int64), anchor) >> np.uint64(16)) & ~np.uint64(3) | np.uint64(level)


def among(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``hot``."""
    if not len(hot):
        return np.zeros(len(values), bool)
    return hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values


def segments(flat: np.ndarray, offsets: np.ndarray, hot: np.ndarray, length: int = LENGTH) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first start, number of starts, anchor value) of the runs of each level.

    A start is a place where ``length`` bytes of one document follow.  The first
    level has all starts, in runs by their ``ANCHORS[0]``-byte anchors; a further
    level those of the runs before whose value is in ``hot`` (sorted), in runs by
    longer anchors, and the last one each start by itself, valued by the whole string.  Equal
    strings take the same way.
    """
    found: list[list[tuple[np.ndarray, ...]]] = [[] for _ in ANCHORS]
    edge = np.zeros(len(flat) + 1, np.int64)
    long = np.diff(offsets) >= length
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    for low in range(0, len(flat), CHUNK):
        here = flat[low:min(len(flat), low + CHUNK + length - 1)]
        starts = np.nonzero(valid[low:min(low + CHUNK, len(flat))])[0]
        place = starts
        for level in range(len(ANCHORS)):
            if not len(starts):
                break
            begin, count, value = anchored(here, place, level, length)
            found[level].append((starts[begin] + low, count, value))
            apart = among(value, hot)
            if not apart.any():
                break
            # further levels look at the bytes of their strings only
            of = spread(begin[apart], count[apart])
            starts, place = starts[of], place[of]
            opens = np.nonzero(np.concatenate([[True], place[1:] - place[:-1] >= length]))[0]
            size = place[np.append(opens[1:], len(place)) - 1] + length - place[opens]
            here = here[spread(place[opens], size)]
            place = place + np.repeat(np.cumsum(size) - size - place[opens], np.diff(np.append(opens, len(place))))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return [tuple(np.concatenate(c) for c in zip(*runs, strict=True)) if runs else none for runs in found]


def bucket_cuts(values: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the buckets (top ``bits`` of 48) in sorted values."""
    return np.searchsorted(values, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(48 - bits))


def narrow(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def widen(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


class Announced:
    """A block's distinct anchors of one level, sorted, in the way any task repeats."""

    def __init__(self, row: dict, bits: int, level: int, hot: np.ndarray):
        _, offsets, flat = opened(row)
        first, count, value = segments(flat, offsets, hot)[level]
        self.values, of = np.unique(value, return_inverse=True)
        self.cuts = bucket_cuts(self.values, bits)
        self.repeated = np.bincount(of, minlength=len(self.values)) > 1
        again = np.nonzero(self.repeated[of])[0]  # distinct segments of each repeated anchor
        content = span_hash(flat, first[again], first[again] + count[again] + LENGTH - 1) if len(again) else np.zeros(0, np.uint64)
        order = np.lexsort((content, of[again]))
        o, c = of[again][order], content[order]
        new = np.concatenate([[True], (o[1:] != o[:-1]) | (c[1:] != c[:-1])]) if len(o) else np.zeros(0, bool)
        self.distinct = np.bincount(o[new], minlength=len(self.values))


class Candidates:
    """The distinct segments of a block whose anchor occurs elsewhere, in an order that any task repeats."""

    def __init__(self, row: dict, bits: int, told: list[dict], hot: np.ndarray):
        self.ids, self.offsets, self.flat = opened(row)
        taken = []
        for level, (first, count, value) in enumerate(segments(self.flat, self.offsets, hot)):
            values, of = np.unique(value, return_inverse=True)
            cuts, met = bucket_cuts(values, bits), np.zeros(len(values), bool)
            for r in told:
                if r["kind"] == KINDS[level]:
                    a, b = cuts[r["bucket"]], cuts[r["bucket"] + 1]
                    met[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(b - a)).astype(bool)
            # what a hot anchor holds comes again on the next level
            take = (met & ~among(values, hot))[of] if level < len(ANCHORS) - 1 else met[of]
            taken.append((first[take], count[take], value[take]))
        self.first, self.count, value = (np.concatenate(c) for c in zip(*taken, strict=True))
        self.doc = np.searchsorted(self.offsets, self.first, "right") - 1
        own = self.ids[self.doc]
        content = span_hash(self.flat, self.first, self.first + self.count + LENGTH - 1) if len(self.first) else np.zeros(0, np.uint64)
        order = np.lexsort((own, content, value))
        v, c = value[order], content[order]
        new = np.concatenate([[True], (v[1:] != v[:-1]) | (c[1:] != c[:-1])]) if len(v) else np.zeros(0, bool)
        self.lead = order[new]  # of each distinct segment, the occurrence of the smallest document
        self.segment = np.zeros(len(order), np.int64)
        self.segment[order] = np.cumsum(new) - 1
        self.lead_cuts = bucket_cuts(value[self.lead], bits)
        self.part_cuts = bucket_cuts(value[self.lead], bits + PART_BITS)


NOT_HOT = np.zeros(0, np.uint64)


def anchor_lists(blocks: DataFrame, bits: int, level: int = 0, hot: np.ndarray = NOT_HOT) -> DataFrame:
    """(bucket, block, anchors, twice, distinct): each block's distinct anchors of a level, sorted, whether the block has them more than once, and of those that it has, how many distinct segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Announced(row, bits, level, hot)
                full = np.nonzero(np.diff(c.cuts))[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int64)), pa.array(np.full(len(full), row["block"], np.int64)),
                     pa.array([narrow(c.values[c.cuts[b]:c.cuts[b + 1]]) for b in full], pa.binary()),
                     pa.array([np.packbits(c.repeated[c.cuts[b]:c.cuts[b + 1]]).tobytes() for b in full], pa.binary()),
                     pa.array([c.distinct[c.cuts[b]:c.cuts[b + 1]][c.repeated[c.cuts[b]:c.cuts[b + 1]]].astype("<u4").tobytes() for b in full], pa.binary())],
                    ["bucket", "block", "anchors", "twice", "distinct"])

    return blocks.mapInArrow(run, "bucket long, block long, anchors binary, twice binary, distinct binary")


def shared_anchors(lists: DataFrame, hot_segments: int = HOT_SEGMENTS, level: int = 0) -> DataFrame:
    """(block, kind of the level, bucket, bits): which of a block's anchors also stand elsewhere, in the order sent.

    A row of kind 2 has the anchors of a bucket that have more than ``hot_segments`` segments.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        sent = [widen(x.as_py()) for x in table.column("anchors")]
        sizes = np.array([len(s) for s in sent])
        twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=n) for x, n in zip(table.column("twice"), sizes, strict=True)]).astype(bool)
        values, of, number = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        met = (number[of] > 1) | twice
        held = np.ones(len(of), np.int64)
        held[twice] = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("distinct")])
        hot = values[np.bincount(of, held) > hot_segments]
        ends = np.cumsum(sizes)
        bits = [np.packbits(met[e - n:e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        told = reply(table.column("block"), KINDS[level], key[0].as_py(), bits)
        return pa.concat_tables([told, reply(pa.chunked_array([[-1]], pa.int64()), 2, key[0].as_py(), [narrow(hot)])]) if len(hot) else told

    return lists.groupBy("bucket").applyInArrow(run, REPLY)


REPLY = "block long, kind int, bucket long, bits binary"


def reply(block: pa.ChunkedArray, kind: int, bucket: int, bits: list[bytes]) -> pa.Table:
    n = len(bits)
    return pa.table({"block": block, "kind": pa.array([kind] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int64()), "bits": pa.array(bits, pa.binary())})


def candidate_segments(blocks: DataFrame, replies: DataFrame, bits: int, hot: np.ndarray = NOT_HOT) -> DataFrame:
    """(bucket, block, parts, counts, docs, data): each block's distinct candidate segments with the smallest document that holds them.

    ``parts`` tells how many of them fall into each part of the bucket.
    """
    def run(key: tuple, block: pa.Table, told: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"bucket": [], "block": [], "parts": [], "counts": [], "docs": [], "data": []}
        for row in block.to_pylist():
            c = Candidates(row, bits, told.to_pylist(), hot)
            for b in np.nonzero(np.diff(c.lead_cuts))[0]:
                lead = c.lead[c.lead_cuts[b]:c.lead_cuts[b + 1]]
                size = c.count[lead] + LENGTH - 1
                at = spread(c.first[lead], size)
                rows["bucket"].append(int(b))
                rows["block"].append(row["block"])
                rows["parts"].append(np.diff(c.part_cuts[b << PART_BITS:((b + 1) << PART_BITS) + 1]).tolist())
                rows["counts"].append(c.count[lead].astype(np.uint8).tobytes())
                rows["docs"].append(packed(np.diff(c.ids[c.doc[lead]], prepend=0).astype("<i8")))
                rows["data"].append(packed(c.flat[at]))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(rows.items(), kinds, strict=True)})

    return (blocks.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInArrow(run, "bucket long, block long, parts array<long>, counts binary, docs binary, data binary"))


def sorted_places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in order of their key, keys in order); the place rides in the low ``bits`` of one sorted word."""
    word = np.sort((key << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64))
    return (word & np.uint64((1 << bits) - 1)).astype(np.int64), word >> np.uint64(bits)


def leading(symbols: np.ndarray, most: int, bits: int) -> tuple[np.ndarray, int, int]:
    """(the first symbols from each place as one word of at most ``bits`` bits, how many they are, bits of each); at most ``most``."""
    dense = np.cumsum(np.bincount(symbols) > 0)[symbols].astype(np.uint64)  # 0 stands for what is beyond the end
    width = int(dense.max()).bit_length()
    span = min(most, bits // width)
    padded = np.concatenate([dense, np.zeros(span, np.uint64)])
    key = np.zeros(len(symbols), np.uint64)
    for i in range(span):
        key <<= np.uint64(width)
        key |= padded[i:i + len(symbols)]
    return key, span, width


def bounded_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols that follow, at least; ties in any order.

    The span that is known to be sorted doubles from round to round, and a
    round sorts only the places that share the span with others.  While
    two ranks and a place fit in a word, words are sorted; a text of over two
    million symbols sorts places by their keys instead, with the same result.
    """
    size = len(symbols)
    bits = max(1, size.bit_length())
    fits = 3 * bits <= 64
    key, span, _ = leading(symbols, depth, 64 - bits if fits else 63)
    slots, order = np.arange(size), np.empty(size, np.int64)
    rank = np.zeros(size + depth, np.uint32)  # 1 more than the first slot of a place's group; 0 beyond the end
    place = slots
    while True:
        if fits:
            by, ranked = sorted_places(key, bits)
        else:
            by = np.argsort(key)
            ranked = key[by]
        place = place[by]
        order[slots] = place
        head = np.ones(len(slots) + 1, bool)
        head[1:-1] = ranked[1:] != ranked[:-1]
        if span >= depth:
            return order
        rank[place] = np.repeat(slots[head[:-1]], np.diff(np.nonzero(head)[0])) + 1
        shared = ~(head[:-1] & head[1:])
        slots, place = slots[shared], place[shared]
        if not len(slots):
            return order
        key = (rank[place].astype(np.uint64) << np.uint64(bits)) | rank[place + span]
        span *= 2


def repeat_bounds(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each row of the order, whether it shares fewer than ``length`` symbols with the row before.

    Common prefixes are found by increasing value: a queue of intervals, one
    for each string so far, starts with the empty string.  A string extended to
    the left by each symbol that precedes it (read off the Burrows-Wheeler
    transform) gives new intervals; the row after an interval's end that has no
    value yet gets the string's length, and that interval joins the next
    round.  The rounds stop at ``length``.  Only interval ends are used, so an
    order of ``length`` symbols' depth is enough.  The first quarter of the rounds, in which nearly all
    intervals are new, is not walked: as many symbols as a word takes are compared at once,
    which leaves the same queue.
    """
    size = len(symbols)
    last = symbols[order - 1]
    source = sorted_places(last.astype(np.uint64), size.bit_length())[0]  # row whose preceding symbol leads to each row
    lead = last[source]
    turn = np.concatenate([[True], lead[1:] != lead[:-1]])
    source = source.astype(np.int32)
    forward = np.empty(size, np.int32)
    forward[source] = np.arange(size, dtype=np.int32)
    word, known, symbol_bits = leading(symbols, length // 4, 63)
    differ = word[order[1:]] ^ word[order[:-1]]
    bound = np.ones(size + 1, bool)
    bound[1:-1] = differ > 0
    low, high = np.array([0]), np.array([size])
    if known:
        ends = np.nonzero(bound)[0]
        fresh = np.nonzero((differ[ends[1:-1] - 1] >> np.uint64(symbol_bits)) == 0)[0]  # only the last of the symbols is another
        low, high = ends[fresh], ends[fresh + 1]
    for _ in range(known, length):
        width = high - low
        total = int(width.sum())
        if not total:
            break
        if total * 8 > size:
            gap = np.diff(low, prepend=0) - np.concatenate([[0], width[:-1]])
            sizes = np.append(np.stack([gap, width], axis=1).ravel(), size - high[-1])
            labels = np.append(np.stack([np.full(len(low), -1), np.arange(len(low))], axis=1).ravel(), -1).astype(np.int32)
            owner = np.repeat(labels, sizes)[source]
            change = turn.copy()
            change[1:] |= owner[1:] != owner[:-1]
            begin = np.nonzero(change)[0]
            end = np.append(begin[1:], size)
            inside = owner[begin] >= 0
            begin, end = begin[inside], end[inside]
        else:
            rows = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(total)
            which = np.repeat(np.arange(len(low)), width)
            by, to = sorted_places(forward[rows].astype(np.uint64), total.bit_length())
            to, which, symbol = to.astype(np.int64), which[by], last[rows[by]]
            first = np.nonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (symbol[1:] != symbol[:-1])]))[0]
            begin, end = to[first], to[np.append(first[1:], len(to)) - 1] + 1
        new = ~bound[end]
        bound[end] = True
        low, high = begin[new], end[new]
    return bound[:size]


def starts_in_smaller(count: np.ndarray, doc: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """For each start of each segment (``count`` starts, ``flat`` their bytes), whether a segment of a smaller document has its string."""
    stop = np.cumsum(count + LENGTH - 1)
    start = stop - count - LENGTH + 1
    # equal segments of different blocks are one text of the index, with their smallest document
    _, lead, of = np.unique(span_hash(flat, start, stop), return_index=True, return_inverse=True)
    holder = np.full(len(lead), NOBODY, np.int64)
    np.minimum.at(holder, of, doc)
    n = count[lead]
    base = np.cumsum(n + LENGTH) - n - LENGTH
    symbols = np.ones(int((n + LENGTH).sum()) + 1, np.int16)  # 1 separates, 0 ends, a byte is 2 more than its value
    symbols[-1] = 0
    symbols[spread(base, n + LENGTH - 1)] = flat[spread(start[lead], n + LENGTH - 1)].astype(np.int16) + 2
    order = bounded_order(symbols, LENGTH)
    bound = repeat_bounds(symbols, order, LENGTH)
    group = np.empty(len(symbols), np.int32)
    group[order] = np.cumsum(bound) - 1
    strings = group[spread(base, n)]  # the group of each start that counts; other rows hold no string of their own
    least = np.full(int(bound.sum()), NOBODY, np.int64)
    np.minimum.at(least, strings, np.repeat(holder, n))
    where = np.cumsum(n) - n
    return least[strings[spread(where[of], count)]] < np.repeat(doc, count)


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (size[i] of them), one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def earlier_copies(found: DataFrame) -> DataFrame:
    """(block, kind 1, bucket, bits): for each start of the segments sent, whether its string starts in a smaller document than the segment's."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(x.as_py(), np.uint8).astype(np.int64) for x in table.column("counts")]
        docs = [np.cumsum(unpacked(x.as_py(), 8 * len(n)).view("<i8")) for x, n in zip(table.column("docs"), counts, strict=True)]
        data = [unpacked(x.as_py(), int((n + LENGTH - 1).sum())) for x, n in zip(table.column("data"), counts, strict=True)]
        cuts = [np.concatenate([[0], np.cumsum(x.as_py())]) for x in table.column("parts")]
        starts = [np.concatenate([[0], np.cumsum(n)]) for n in counts]
        answers: list[list[np.ndarray]] = [[] for _ in counts]
        for part in range(1 << PART_BITS):
            mine = [i for i, c in enumerate(cuts) if c[part + 1] > c[part]]
            if not mine:
                continue
            ranges = [(cuts[i][part], cuts[i][part + 1]) for i in mine]
            earlier = starts_in_smaller(
                np.concatenate([counts[i][a:b] for i, (a, b) in zip(mine, ranges, strict=True)]), np.concatenate([docs[i][a:b] for i, (a, b) in zip(mine, ranges, strict=True)]),
                np.concatenate([data[i][starts[i][a] + a * (LENGTH - 1):starts[i][b] + b * (LENGTH - 1)] for i, (a, b) in zip(mine, ranges, strict=True)]))
            at = 0
            for i, (a, b) in zip(mine, ranges, strict=True):
                size = int(starts[i][b] - starts[i][a])
                answers[i].append(earlier[at:at + size])
                at += size
        bits = [np.packbits(np.concatenate(a)).tobytes() for a in answers]
        return reply(table.column("block"), 1, key[0].as_py(), bits)

    return found.groupBy("bucket").applyInArrow(run, REPLY)


def covered(blocks: DataFrame, replies: DataFrame, bits: int, with_text: bool = False, hot: np.ndarray = NOT_HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and the remaining bytes if asked for."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")

    def run(key: tuple, block: pa.Table, told: pa.Table) -> pa.Table:
        out: dict[str, list] = {n.split()[0]: [] for n in schema.split(", ")}
        answers = told.to_pylist()
        for row in block.to_pylist():
            c = Candidates(row, bits, answers, hot)
            number = c.count[c.lead]
            flag = np.zeros(int(number.sum()), bool)
            ends = np.concatenate([[0], np.cumsum(number)])
            for r in answers:
                if r["kind"] == 1:
                    a, b = ends[c.lead_cuts[r["bucket"]]], ends[c.lead_cuts[r["bucket"] + 1]]
                    flag[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(b - a)).astype(bool)
            edge = np.zeros(len(c.flat) + 1, np.int64)
            if len(c.first):
                n = c.count
                starts = spread(c.first, n)
                hit = flag[spread(ends[c.segment], n)]
                # a larger document of the block repeats the segment's smallest one
                hit |= np.repeat(c.ids[c.doc] > c.ids[c.doc[c.lead]][c.segment], n)
                edge += np.bincount(starts[hit], minlength=len(edge))
                edge -= np.bincount(starts[hit] + LENGTH, minlength=len(edge))
            gone = np.cumsum(edge[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            opens[c.offsets[:-1][np.diff(c.offsets) > 0]] = gone[c.offsets[:-1][np.diff(c.offsets) > 0]]
            removed, spans = (np.concatenate([[0], np.cumsum(x)])[c.offsets] for x in (gone, opens))
            for i, doc in enumerate(c.ids.tolist()):
                a, b = c.offsets[i], c.offsets[i + 1]
                kept = c.flat[a:b] if removed[i + 1] == removed[i] else c.flat[a:b][~gone[a:b]]
                out["doc_id"].append(doc)
                out["n_bytes"].append(int(b - a))
                out["n_removed"].append(int(removed[i + 1] - removed[i]))
                out["n_spans"].append(int(spans[i + 1] - spans[i]))
                out["kept_sha256"].append(hashlib.sha256(kept.tobytes()).hexdigest())
                if with_text:
                    out["kept"].append(kept.tobytes())
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds, strict=False)})

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK_BYTES, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """Every document with what is left after each byte that an earlier document's 50-byte string covers is removed.

    Strings are judged on the input, overlaps count, matches stay inside a
    document, and "earlier" is a smaller doc_id (rows that repeat a doc_id do not
    remove from each other).  Null and empty texts have 0 bytes.
    The result has a row for each input row.  A row with a null doc_id has no
    place in the order: it keeps all of its bytes and removes none.

    Documents travel in compressed blocks.  Blocks announce their anchors, learn
    which ones stand elsewhere, and send only the segments around those to the
    anchor's bucket.  There a Burrows-Wheeler transform of the distinct segments finds
    all strings of 50 bytes that occur again, and the blocks are told for each start whether a
    smaller document has its string.  A segment that a block or a bucket holds
    many times travels and is indexed once, with its smallest document.

    The segments of one anchor meet in one task.  Anchors of more than ``hot_segments``
    (a common phrase in ever different surroundings) are known after the
    announcement; their strings alone are announced again by longer anchors, in
    runs as before, and those of anchors that are hot even then string by string.  The driver gets at
    most one such anchor for each ``hot_segments`` segments of the corpus.

    Distinct segments and anchors are told apart by 64-bit and 48-bit hashes; strings in a bucket by their bytes.
    """
    blocks = text_blocks(docs.where("doc_id is not null"), block_bytes)
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = max(0, (-(-int(total) // bucket_bytes) - 1).bit_length())
    met, hot = announced(blocks, bits, hot_segments)
    earlier = earlier_copies(candidate_segments(blocks, met, bits, hot))
    content = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    apart = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.length(content).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                                                F.sha2(content, 256).alias("kept_sha256"), *([content.alias("kept")] if with_text else []))
    return covered(blocks, met.unionByName(earlier), bits, with_text, hot).unionByName(apart)


def announced(blocks: DataFrame, bits: int, hot_segments: int = HOT_SEGMENTS) -> tuple[DataFrame, np.ndarray]:
    """(replies on the anchors of all blocks and levels, the hot anchors, sorted)."""
    hot, replies = NOT_HOT, None
    for level in range(len(ANCHORS)):
        met = stage(shared_anchors(anchor_lists(blocks, bits, level, hot), hot_segments, level))
        mine = met.where(F.col("kind") == KINDS[level])
        replies = mine if replies is None else replies.unionByName(mine)
        found = met.where("kind = 2").select("bits").toArrow().column("bits").to_pylist()
        if not found or level == len(ANCHORS) - 1:
            return replies, hot
        hot = np.unique(np.concatenate([hot, *map(widen, found)]))
