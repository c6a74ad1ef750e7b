"""Packing documents into training sequences with a grouping genetic algorithm on islands."""
from __future__ import annotations

import os
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.session import stage

CAPACITY = 1024  # tokens of a sequence
END_ID = 2
SHARD_ITEMS = 4096  # pieces that one population packs
ISLANDS = 2  # populations of a shard; each is a task of its own
EPOCHS = 2  # evolutions, with a migration of elites before each but the first
GENERATIONS = 8
POPULATION = 6
ELITES = 2  # solutions an island sends on
OPEN_BELOW = 1008  # sequences filled less are packed again, together with those of other shards
CACHE_UNITS = 800_000  # about 160 MB of a Python worker
JOINED = 200  # new units tokenized as one string
SEED = 5
SOLID_GAP = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts as little-endian bytes, with the ids of recurring units kept.

    A space between two characters that are no white space always begins a new
    pre-token, so a text's ids are the ids of its units, cut at those spaces.
    A unit is known by its characters without the space before it; the first
    unit of a text, which has none, by its characters after a space.  New units are tokenized together,
    many to a string, and told apart by the bytes their tokens stand for.  A full
    cache keeps what it has and changes no result.

    With ``added_tokens``, the tokenizer's own default, the text of an added token
    is that token: texts are cut there first.  Without, it is text like any other.
    """

    def __init__(self, path: str, cache_units: int = CACHE_UNITS, added_tokens: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.encode_batch = getattr(self.model, "encode_batch_fast", self.model.encode_batch)
        vocabulary = self.model.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # byte-level: a character of a token stands for a byte
            self.sizes[number] = len(token)
        self.units: dict[str, bytes] = {}
        self.most = cache_units
        added = {t.content: (number, t) for number, t in self.model.get_added_tokens_decoder().items()} if added_tokens else {}
        self.added = {content: np.array([number], "<u4").tobytes() for content, (number, _) in added.items()}
        self.marks = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})") if added else None
        # tokens that take in or look at what stands beside them are left to the tokenizer, with the whole text
        self.plain_marks = not any(t.lstrip or t.rstrip or t.single_word or (t.normalized and self.model.normalizer) for _, t in added.values())
        self.whole = Tokenizer.from_file(path) if not self.plain_marks else None

    def ids(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each string)."""
        found = [e.ids for e in self.encode_batch(strings, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.array([len(f) for f in found], np.int64)

    def coded(self, keys: list[str]) -> dict[str, bytes]:
        plain = [k for k in keys if solid(k)]
        rest = [k for k in keys if not solid(k)]
        out: dict[str, bytes] = {}
        if plain:
            ids, _ = self.ids([" " + " ".join(plain[i:i + JOINED]) for i in range(0, len(plain), JOINED)])
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(k.encode()) + 1 for k in plain])) + 1
            out.update(cut(plain, ids, ends))
        if rest:
            ids, counts = self.ids([k[1:] if k[0] == " " else " " + k for k in rest])
            out.update(cut(rest, ids, np.cumsum(counts)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.whole is not None:
            return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        if self.marks is None or not any(map(self.marks.search, texts)):
            return self.encode_plain(texts)
        parts = [self.marks.split(text) for text in texts]  # every other part is an added token
        between = iter(self.encode_plain([p for each in parts for p in each[::2]]))
        return [b"".join([self.added[p] if i % 2 else next(between) for i, p in enumerate(each)]) for each in parts]

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        split = []
        for text in texts:
            first, *more = text.split(" ")
            split.append([" " + first, *more])
        known = self.units
        new = set().union(*split).difference(known)
        odd = {k for k in new if not solid(k[1:] if k[:1] == " " else k)}
        if odd:  # white space meets white space: cut at the other gaps only
            for i, parts in enumerate(split):
                if not odd.isdisjoint(parts):
                    first, *more = SOLID_GAP.split(texts[i])
                    split[i] = [" " + first, *more]
            new = set().union(*split).difference(known)
        more = self.coded(list(new))
        if len(known) + len(more) <= self.most:
            known.update(more)
            return [b"".join(map(known.__getitem__, parts)) for parts in split]
        return [b"".join([known[k] if k in known else more[k] for k in parts]) for parts in split]


def solid(key: str) -> bool:
    """Neither end is white space."""
    return key != "" and not key[0].isspace() and not key[-1].isspace()


def cut(keys: list[str], ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple[str, bytes]]:
    data = ids.astype("<u4").tobytes()
    at = 0
    for key, end in zip(keys, (4 * ends).tolist(), strict=True):
        yield key, data[at:end]
        at = end


@lru_cache(maxsize=1)
def encoder_of(path: str, cache_units: int = CACHE_UNITS) -> Encoder:
    """The encoder of this Python process, with the tokenizer's default for added tokens; later tasks find its units."""
    return Encoder(path, cache_units, added_tokens=True)


def text_groups(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with about ``limit`` characters; null is empty."""
    low, size, texts = 0, 0, []
    for i, text in enumerate(column):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= limit:
            yield low, texts
            low, size, texts = i + 1, 0, []
    if texts:
        yield low, texts


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, cache_units: int = CACHE_UNITS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids followed by ``end_id``.

    A document of more than ``capacity`` ids is cut into pieces of
    ``capacity``, of which the first may be shorter.  Null texts count as empty.
    """
    path = tokenizer or tokenizer_file()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, cache_units)
        for batch in batches:
            for low, texts in text_groups(batch.column(1)):
                rows: list[tuple] = []
                for key, ids in zip(batch.column(0).slice(low, len(texts)).to_pylist(), encoder.encode(texts), strict=True):
                    ids += end
                    total = len(ids) // 4
                    start, piece, length = 0, 0, (total - 1) % capacity + 1
                    while start < total:
                        rows.append((key, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                        start, piece, length = start + length, piece + 1, capacity
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A solution: bins of item numbers with their fills; best fit in constant time by a bit mask of the gaps."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.fill = capacity, [], []

    def best_fit(self, items: list[int], sizes: list[int]) -> None:
        by_gap: dict[int, list[int]] = {}
        mask = 0
        for b, f in enumerate(self.fill):
            gap = self.capacity - f
            if gap:
                by_gap.setdefault(gap, []).append(b)
                mask |= 1 << gap
        for item in items:
            size = sizes[item]
            room = mask >> size
            if room:
                gap = size + (room & -room).bit_length() - 1
                stack = by_gap[gap]
                b = stack.pop()
                if not stack:
                    mask &= ~(1 << gap)
                self.bins[b].append(item)
                self.fill[b] += size
            else:
                b, gap = len(self.bins), self.capacity
                self.bins.append([item])
                self.fill.append(size)
            left = gap - size
            if left:
                by_gap.setdefault(left, []).append(b)
                mask |= 1 << left

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        return -len(self.bins), sum(f * f for f in self.fill)


def crossover(a: Bins, b: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Inject well-filled bins of ``b`` into ``a``; bins of ``a`` with a duplicate go, what they lose is placed by best fit, largest first."""
    ranked = sorted(range(len(b.bins)), key=lambda i: -b.fill[i])
    full = ranked[:max(1, len(ranked) * 3 // 4)]
    chosen = rng.sample(full, max(1, len(full) // 4))
    inside = {i for k in chosen for i in b.bins[k]}
    child, lost = Bins(a.capacity), []
    for items, fill in zip(a.bins, a.fill, strict=True):
        if inside.isdisjoint(items):
            child.bins.append(list(items))
            child.fill.append(fill)
        else:
            lost.extend(i for i in items if i not in inside)
    for k in chosen:
        child.bins.append(list(b.bins[k]))
        child.fill.append(b.fill[k])
    child.best_fit(sorted(lost, key=lambda i: -sizes[i]), sizes)
    return child


def mutated(a: Bins, sizes: list[int], rng: random.Random) -> Bins:
    """Empty the worst bins and a few others, and place their items anew."""
    ranked = sorted(range(len(a.bins)), key=lambda i: a.fill[i])
    gone = set(ranked[:3]) | set(rng.sample(range(len(a.bins)), min(len(a.bins), 1 + len(a.bins) // 50)))
    child = Bins(a.capacity)
    lost = []
    for k, items in enumerate(a.bins):
        if k in gone:
            lost.extend(items)
        else:
            child.bins.append(list(items))
            child.fill.append(a.fill[k])
    child.best_fit(sorted(lost, key=lambda i: -sizes[i]), sizes)
    return child


def evolve(sizes: list[int], capacity: int, seed: int, given: list[np.ndarray], generations: int = GENERATIONS, population: int = POPULATION) -> list[Bins]:
    """The best solutions after some generations, best first; ``given`` are solutions as a bin number for each item."""
    rng = random.Random(seed)
    bound = -(-sum(sizes) // capacity)
    people = []
    for bin_of in given:
        solution = Bins(capacity)
        solution.bins = [[] for _ in range(int(bin_of.max()) + 1)] if len(bin_of) else []
        for item, b in enumerate(bin_of.tolist()):
            solution.bins[b].append(item)
        solution.fill = [sum(sizes[i] for i in items) for items in solution.bins]
        people.append(solution)
    if not people:
        first = Bins(capacity)
        first.best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes)
        people.append(first)
    while len(people) < population and len(people[0].bins) > bound:
        noise = [s * rng.uniform(0.7, 1.3) for s in sizes]
        other = Bins(capacity)
        other.best_fit(sorted(range(len(sizes)), key=lambda i: -noise[i]), sizes)
        people.append(other)
    people.sort(key=Bins.fitness, reverse=True)
    for _ in range(generations):
        if len(people[0].bins) <= bound:
            break
        young = []
        for _ in range(max(1, population // 2)):
            a, b = rng.sample(people, 2) if len(people) > 1 else (people[0], people[0])
            child = crossover(max(a, b, key=Bins.fitness), min(a, b, key=Bins.fitness), sizes, rng)
            young.append(mutated(child, sizes, rng) if rng.random() < 0.3 else child)
        people = sorted(people + young, key=Bins.fitness, reverse=True)[:population]
    return people


def numbered(solution: Bins, count: int) -> np.ndarray:
    out = np.zeros(count, np.int32)
    for b, items in enumerate(solution.bins):
        out[items] = b
    return out


def islands(items: DataFrame, shards: int, capacity: int, epochs: int = EPOCHS, count: int = ISLANDS) -> DataFrame:
    """(doc_id, piece, length, shard, bin, offset, fill): the best packing of every shard.

    Each shard's pieces are packed by ``count`` populations in tasks of their
    own; between epochs an island gets the elites of its neighbour beside its
    own.  Solutions travel as a bin number for each piece, in the order of
    (length, doc_id, piece).
    """
    items = items.select("doc_id", "piece", "length", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int").alias("shard"))
    each = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    solution = "shard int, island int, score long, fill double, bins binary"

    def ordered(table: pa.Table) -> pa.Table:
        return table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])

    def told(shard: int, island: int, people: list[Bins], size: int) -> pa.Table:
        best = people[:ELITES]
        return pa.table({"shard": pa.array([shard] * len(best), pa.int32()), "island": pa.array([island] * len(best), pa.int32()),
                         "score": pa.array([-len(p.bins) for p in best], pa.int64()), "fill": pa.array([p.fitness()[1] for p in best], pa.float64()),
                         "bins": pa.array([numbered(p, size).tobytes() for p in best], pa.binary())})

    def begin(key: tuple, table: pa.Table) -> pa.Table:
        shard, island = (k.as_py() for k in key)
        sizes = ordered(table).column("length").to_pylist()
        return told(shard, island, evolve(sizes, capacity, SEED + 1000 * shard + island, []), len(sizes))

    found = stage(each.groupBy("shard", "island").applyInArrow(begin, solution))
    for epoch in range(1, epochs):
        seed = SEED + 10 ** 6 * epoch

        def go_on(key: tuple, table: pa.Table, elites: pa.Table) -> pa.Table:
            shard, island = (k.as_py() for k in key)
            sizes = ordered(table).column("length").to_pylist()
            given = [np.frombuffer(b.as_py(), np.int32) for b in elites.column("bins")]
            return told(shard, island, evolve(sizes, capacity, seed + 1000 * shard + island, given), len(sizes))

        moved = found.withColumn("island", F.pmod(F.col("island") + 1, F.lit(count)).cast("int"))
        arrivals = found.unionByName(moved).distinct()
        found = stage(each.groupBy("shard", "island").cogroup(arrivals.groupBy("shard", "island")).applyInArrow(go_on, solution))

    best = (found.groupBy("shard").agg(F.max(F.struct("score", "fill", "bins")).alias("best"))
            .select("shard", F.col("best.bins").alias("bins")))

    def place(key: tuple, table: pa.Table, chosen: pa.Table) -> pa.Table:
        table = ordered(table)
        bins = np.frombuffer(chosen.column("bins")[0].as_py(), np.int32).astype(np.int64)
        size = table.column("length").to_numpy()
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        first = np.searchsorted(bins[order], bins[order], "left")
        offset = np.zeros(len(size), np.int64)
        offset[order] = before - before[first]
        fill = np.bincount(bins, size, int(bins.max()) + 1).astype(np.int64)[bins]
        for name, values in (("bin", bins), ("offset", offset), ("fill", fill)):
            table = table.append_column(name, pa.array(values))
        return table

    return items.groupBy("shard").cogroup(best.groupBy("shard")).applyInArrow(
        place, "doc_id long, piece int, length long, shard int, bin long, offset long, fill long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, shard_items: int = SHARD_ITEMS, cache_units: int = CACHE_UNITS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in a sequence.

    Pieces of the full capacity are sequences by themselves.  The others are
    packed in shards of about ``shard_items``; sequences that a shard leaves
    rather open are packed again, across shards.  An empty table gives none.
    Rows that repeat a doc_id are packed like others.  A Python worker keeps
    ``cache_units`` recurring units, about 200 bytes each; the result does not depend on it.
    """
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id, cache_units).withColumn("copy", F.monotonically_increasing_id()))
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("copy")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < capacity)
    # a piece is known by its row from here on: doc_id may repeat
    items = short.select(F.col("copy").alias("doc_id"), "piece", "length")
    shards = -(-items.count() // shard_items)
    if not shards:
        return whole
    first = stage(islands(items, shards, capacity))
    width = 1 << 31
    done = first.where(F.col("fill") >= OPEN_BELOW).select("doc_id", "piece", (F.col("shard").cast("long") * width + F.col("bin")).alias("sequence_id"), "offset")
    rest = first.where(F.col("fill") < OPEN_BELOW).select("doc_id", "piece", "length")
    again = -(-rest.count() // shard_items)
    if again:
        second = islands(rest, again, capacity)
        done = done.unionByName(second.select("doc_id", "piece", ((F.col("shard").cast("long") + shards) * width + F.col("bin")).alias("sequence_id"), "offset"))
    placed = done.select(F.col("doc_id").alias("copy"), "sequence_id", "offset")
    return whole.unionByName(short.join(placed, "copy").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
