"""Near copies: bit-sliced comparison of fingerprints, bands of minimum hashes for what lies beyond its radius, exact similarity of shingle sets."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import mixed, slices
from lanestride.llm.graph import components
from lanestride.llm.simhash import RADIUS, fingerprint_of, node_links, shingle_hashes
from lanestride.session import stage

SHINGLE = 5  # words
SIMILAR = (4, 5)  # least Jaccard similarity of two near copies, as a fraction
BANDS, ROWS = 64, 8  # a pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 8) ** 64 = 0.000008
TILE_DOCS = 4096  # documents and shingles that one comparison task holds from either side
TILE_SHINGLES = 1 << 20
GATHER = 1 << 20
_SEEDS = np.random.default_rng(7).integers(0, 1 << 63, (2, BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.random.default_rng(8).integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: bytes) -> np.ndarray:
    """Distinct shingle hashes, sorted; a text without a word has one of its own, so that such texts are equal."""
    return set_of(shingle_hashes(text, SHINGLE))


def set_of(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key for each band: sets with equal minima under the band's hash functions have equal keys."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for low in range(0, len(shingles), 256):
        np.minimum(least, ((shingles[low:low + 256] ^ _SEEDS[0]) * _SEEDS[1]).min(axis=1), out=least)
    return mixed((mixed(least).reshape(BANDS, ROWS) * _FOLD).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def banded(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, shingles, keys) of every document: its fingerprint, the number of its shingles and its band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, offsets in slices(batch, "text"):
                raw = flat.tobytes()
                hashes = [shingle_hashes(raw[a:b], SHINGLE) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                prints = np.array([fingerprint_of(h) for h in hashes], np.uint64).view(np.int64)
                sets = [set_of(h) for h in hashes]
                keys = np.concatenate([band_keys(s) for s in sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(prints), pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(keys))], ["doc_id", "fp", "shingles", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long, shingles long, keys array<long>")


def fingerprint_candidates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, least): links that connect documents whose fingerprints differ in at most ``radius`` bits, by operator 5's bit-sliced comparison."""
    nodes, links = node_links(prints.select("doc_id", "fp"), radius)
    same = prints.select("doc_id", "fp").join(nodes, "fp").where("doc_id <> node").select("doc_id", F.col("node").alias("least"))
    return same.unionByName(links.select(F.col("x").alias("doc_id"), F.col("y").alias("least"))).distinct()


def similar_links(sets: list[np.ndarray], left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets of at least the least similarity, by exact counts of common shingles.

    With ``left`` only pairs of a set of the left side and one of the right
    side are looked at.  Sets that are connected already get no further link.
    """
    count, size = len(sets), np.array([len(s) for s in sets])
    ends = np.cumsum(size)
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(count), size)[np.argsort(number, kind="stable")]
    often = np.bincount(number)
    first = np.cumsum(often) - often
    label = np.arange(count)
    links, classes = [], count
    for i in range(count):
        if classes == 1:
            break
        if left is not None and not left[i]:
            continue
        own = number[ends[i] - size[i]:ends[i]]
        common = np.zeros(count, np.int64)
        cut = np.cumsum(often[own]) // GATHER
        for piece in np.split(own, np.nonzero(np.diff(cut))[0] + 1):
            n = often[piece]
            common += np.bincount(holder[np.repeat(first[piece] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], minlength=count)
        near = SIMILAR[1] * common >= SIMILAR[0] * (size[i] + size - common)
        near &= ~left if left is not None else np.arange(count) > i
        for j in np.nonzero(near)[0].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                links.append((i, j))
                classes -= 1
    return links


def near_copies(docs: DataFrame, tile_docs: int = TILE_DOCS, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """(node, component) of documents with a near copy: component is the smallest doc_id reachable.

    Documents are linked when the sets of their 5-word shingles have a Jaccard
    similarity of 0.8 or more.  Documents are connected first where operator 5's
    bit-sliced comparison finds their fingerprints of the same shingles close; a pair of 0.8
    differs in some 10 of 64 bits, beyond any radius with selective blocks, so documents
    that share a band of minimum hashes are connected as well.  Each class found so is then
    compared exactly, in tiles of bounded size, each pair of tiles in a task of its own.
    """
    keys = stage(banded(docs))
    rows = keys.select("doc_id", F.explode("keys").alias("key"))
    met = rows.groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    maybe = rows.join(met, F.col("key") == F.col("_key")).where("doc_id <> least").select("doc_id", "least").distinct()
    maybe = fingerprint_candidates(keys).unionByName(maybe)
    class_of = stage(components(maybe, "doc_id", "least")
                     .join(keys.select(F.col("doc_id").alias("node"), "shingles").distinct(), "node"))
    parts = class_of.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / F.lit(tile_docs)), F.ceil(F.sum("shingles") / F.lit(tile_shingles))).cast("int").alias("parts"))
    placed = class_of.select("node", "component").distinct().join(parts, "component")
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.groupBy("node", "component", "mine").agg(F.collect_list("with").alias("with"))
    members = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(placed, "node").select("node", "component", "mine", F.explode("with").alias("with"), "text")
    tiles = members.select("node", "component", F.least("mine", "with").alias("lo"), F.greatest("mine", "with").alias("hi"), (F.col("mine") <= F.col("with")).alias("left"), "text")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        sets = [shingle_set((t.as_py() or "").encode()) for t in table.column("text")]
        left = None if key[1].as_py() == key[2].as_py() else table.column("left").to_numpy()
        links = np.array(similar_links(sets, left), np.int64).reshape(-1, 2)
        return pa.table({"a": node[links[:, 0]], "b": node[links[:, 1]]})

    return components(tiles.groupBy("component", "lo", "hi").applyInArrow(compare, "a long, b long"))


def drop_near_copies(docs: DataFrame, tile_docs: int = TILE_DOCS, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """Documents with the smallest doc_id of each component left; all columns of the input."""
    dropped = near_copies(docs.select("doc_id", "text"), tile_docs, tile_shingles).where("node <> component").select(F.col("node").alias("doc_id")).distinct()
    return docs.join(dropped, "doc_id", "left_anti")
