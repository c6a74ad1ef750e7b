"""SimHash fingerprints and their near-duplicate components by bit-sliced comparison."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import slices
from lanestride.llm.graph import components
from lanestride.session import stage

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 4096  # fingerprints of one bucket that one comparison task holds from either side
#: A-Z to a-z; other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        grams = iter([b" ".join(words)])
        count = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
        count = len(words) - size + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, count)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set; index 0 is the least bit."""
    bits = np.zeros(BITS, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low:low + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return bits


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    return fingerprint_of(shingle_hashes(text, size, seed))


def fingerprint_of(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    chosen = bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(chosen, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp long): a bit is 1 if more than half of the shingle hashes, repeats included, have it.

    Null and empty texts, and texts of white space only, have fingerprint 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, offsets in slices(batch, "text"):
                raw = flat.tobytes()
                found = [fingerprint(raw[a:b], size, seed) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def blocks(bits: int = BITS, count: int = RADIUS + 2) -> list[tuple[int, int]]:
    """(shift, width) of ``count`` runs of bits that cover the fingerprint."""
    edges = [bits * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical form: row k holds bit k of every value, 64 values to a word."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[:len(values)] = values
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray:
    """Bit matrix (query x value) of the distances of at most ``radius``.

    The distances of 64 values to a query grow together: each plane's XOR with
    the query's bit is added to carry-save counters (ones, twos, fours, ...),
    and a sticky word marks counts beyond what the counters hold.  A query's
    row of words leaves the loop once all of its values are over the radius.
    """
    count, words = len(queries), planes.shape[1]
    depth = max(1, int(radius + 1).bit_length())
    bits = np.unpackbits(queries.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    masks = np.where(bits, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    rows, cells = np.repeat(np.arange(count), words), np.tile(np.arange(words), count)
    counters = [np.zeros(len(rows), np.uint64) for _ in range(depth)]
    over = np.zeros(len(rows), np.uint64)
    out = np.zeros((count, words), np.uint64)
    for k in range(BITS):
        carry = planes[k][cells] ^ masks[rows, k]
        for i in range(depth):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if k % 8 == 7 and k < BITS - 1:
            alive = ~(over | beyond(counters, radius)) != 0
            if not alive.all():
                rows, cells, over = rows[alive], cells[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(rows):
                    return out
    out[rows, cells] = ~(over | beyond(counters, radius))
    return out


def beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over the radius, by a bitwise comparison from the top counter down."""
    more = np.zeros(len(counters[0]), np.uint64)
    same = ~more
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same &= counters[i]
        else:
            more |= same & counters[i]
            same &= ~counters[i]
    return more


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links between left and right fingerprints (or inside left).

    Every class of values linked here stays connected, with at most one link
    for each value and step: a value hangs on the first value it links to.
    """
    inside = right is None
    other = left if inside else right
    planes = planes_of(other)
    a, b = [], []
    step = max(1, (1 << 19) // max(1, planes.shape[1]))
    for low in range(0, len(left), step):
        found = within(left[low:low + step], planes, radius)
        grid = np.unpackbits(found.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, :len(other)].view(bool)
        for i in np.nonzero(grid.any(axis=1))[0]:
            hits = np.nonzero(grid[i])[0]
            if inside:
                hits = hits[hits > low + i]
            a.append(np.full(len(hits), left[low + i], np.uint64))
            b.append(other[hits])
        if sum(map(len, a)) > 1 << 21:
            a, b = map(list, zip(forest(np.concatenate(a), np.concatenate(b)), strict=True))
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return forest(np.concatenate(a), np.concatenate(b))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same classes, one for each value that is not the least of its class."""
    values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[:len(a)], where[len(a):]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while not (root[root] == root).all():
            root = root[root]
        if (before == root).all():
            break
    moved = root != np.arange(len(values))
    return values[moved], values[root[moved]]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that differ in at most ``radius`` bits.

    ``prints`` has one row for each fingerprint ``fp``.  Of radius + 2 blocks of bits two agree in any such pair, so
    pairs meet in buckets of (two blocks, their bits).  Buckets of one leave by
    a count; a bucket of more than ``tile`` is compared as tiles of it, each
    pair of tiles in a task of its own.
    """
    runs = blocks(BITS, radius + 2)
    keys = []
    for n, pair in enumerate(combinations(range(len(runs)), 2)):
        parts = [F.shiftrightunsigned("fp", runs[i][0]).bitwiseAND(F.lit((1 << runs[i][1]) - 1)) for i in pair]
        value = F.shiftleft(parts[0], runs[pair[1]][1]).bitwiseOR(parts[1])
        keys.append(F.struct(F.lit(n).alias("n"), value.alias("value")))
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", F.col("k.n").alias("n"), F.col("k.value").alias("value"))
    size = rows.groupBy(F.col("n").alias("_n"), F.col("value").alias("_v")).agg(F.count("*").alias("size")).where("size > 1")
    met = rows.join(size, (F.col("n") == F.col("_n")) & (F.col("value") == F.col("_v"))).select("fp", "n", "value", "size")
    parts = F.ceil(F.col("size") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = met.withColumn("parts", parts).withColumn("mine", mine)
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("fp", "n", "value", F.least("mine", "with").alias("lo"), F.greatest("mine", "with").alias("hi"),
                     (F.col("mine") <= F.col("with")).alias("left"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(1, 5)])
            if not batch.num_rows:
                continue
            change = (key[:, 1:] != key[:, :-1]).any(axis=0)
            last = int(np.nonzero(change)[0][-1]) + 1 if change.any() else 0
            if held and (last or (np.stack([held[-1].column(i)[-1].as_py() for i in range(1, 5)]) != key[:, 0]).any()):
                yield from compare([*held, batch.slice(0, last)])
                held = []
            elif last:
                yield from compare([batch.slice(0, last)])
            held.append(batch.slice(last))
        if held:
            yield from compare(held)

    def compare(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All tiles of the parts; each tile is whole."""
        table = pa.Table.from_batches(parts)
        key = np.stack([table.column(i).to_numpy() for i in range(1, 5)])
        fp = table.column(0).to_numpy().astype(np.int64).view(np.uint64)
        left = table.column(5).to_numpy()
        cuts = np.concatenate([[0], np.nonzero((key[:, 1:] != key[:, :-1]).any(axis=0))[0] + 1, [key.shape[1]]])
        a, b = [], []
        pairs = np.diff(cuts) == 2
        same = pairs & (key[2][cuts[:-1]] == key[3][cuts[:-1]])
        first = cuts[:-1][same]
        x, y = fp[first], fp[first + 1]  # buckets of two need no planes: their carry-save count is one popcount
        near = np.bitwise_count(x ^ y) <= radius
        a.append(x[near])
        b.append(y[near])
        for low, high in zip(cuts[:-1][~same], cuts[1:][~same], strict=True):
            if key[2][low] == key[3][low]:
                found = tile_links(fp[low:high], None, radius)
            else:
                mine = left[low:high]
                found = tile_links(fp[low:high][mine], fp[low:high][~mine], radius)
            a.append(found[0])
            b.append(found[1])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = met.repartition("n", "value", "lo", "hi").sortWithinPartitions("n", "value", "lo", "hi")
    return dealt.mapInArrow(run, "a long, b long")


def node_links(prints: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """(fp, node) with the smallest doc_id of each fingerprint, staged, and links (x, y) between such nodes, enough to
    connect all whose fingerprints differ in at most ``radius`` bits; from (doc_id, fp) of every document."""
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    links = fingerprint_links(nodes.select("fp"), radius)
    return nodes, (links.join(nodes.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a")
                   .join(nodes.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b").select("x", "y"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Every document with its fingerprint (16 hex digits), its component (smallest doc_id reachable) and its number of links.

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; documents with one fingerprint are linked without being paired.
    Null, empty and blank texts share fingerprint 0.  Rows that repeat a
    doc_id give a result row each.
    """
    prints = stage(fingerprints(docs, size, seed))
    nodes, by_node = node_links(prints, radius)
    class_of = components(by_node, "x", "y")
    classes = (nodes.join(class_of, "node", "left")
               .select("fp", F.coalesce("component", "node").alias("component_id")))
    return (prints.join(classes, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Documents with the smallest doc_id of each component left; all columns of the input."""
    dropped = near_duplicates(docs.select("doc_id", "text"), radius).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
