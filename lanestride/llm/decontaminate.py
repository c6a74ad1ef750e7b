"""Benchmark decontamination with an FM-index for each shard of the training text."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm.radix_dedup import numbered
from lanestride.llm.arrays import slices, span_hash
from lanestride.llm.quality import pieces

WINDOW = 10
SHARD_WORDS = 1 << 20  # indexed words of one shard (or one document's)
BLOCK_WORDS = 1 << 20  # benchmark words searched at once: about 30 MB in a task
SAMPLE = 8  # every so many-th text position is kept with its suffix
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
#: Words are runs of digits, letters and bytes of non-ASCII characters.
GAP = np.array([not (48 <= c <= 57 or 97 <= c <= 122 or c >= 128) for c in range(256)])


class WaveletMatrix:
    """Ranks of every symbol of a sequence, one bit plane a level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        current = values
        for level in reversed(range(bits)):
            bit = (current >> level) & 1
            count = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(values) - int(count[-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        at, base = ends.astype(np.int64), np.zeros(len(ends), np.int64)
        for k, level in enumerate(reversed(range(self.bits))):
            bit = ((symbols >> level) & 1).astype(bool)
            ones, zeros = self.ones[k], self.zeros[k]
            at = np.where(bit, zeros + ones[at], at - ones[at])
            base = np.where(bit, zeros + ones[base], base - ones[base])
        return at - base


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    size = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        after = np.zeros(size, np.int64)
        after[:max(0, size - span)] = rank[span:] + 1
        key = rank * (size + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(size, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = new
        span *= 2
        if size == 0 or rank[order[-1]] == size - 1:
            return order


class FMIndex:
    """Backward search and positions over a sequence of symbols; 0 separates texts."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        text = np.append(text + 1, 0)  # an end of its own below all symbols
        order = suffix_order(text)
        self.last = text[order - 1]  # Burrows-Wheeler transform
        bits = max(1, int(text.max()).bit_length())
        self.ranks = WaveletMatrix(self.last, bits)
        counts = np.bincount(text, minlength=1 << bits)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.symbols = len(counts)
        kept = (order % sample == 0)
        self.kept = kept
        self.place = np.cumsum(kept) - 1
        self.positions = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of each phrase (right-aligned rows of symbols); empty if it does not occur."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.last), np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.nonzero((step < lengths) & (low < high))[0]
            if not len(live):
                break
            c = phrases[live, width - 1 - step] + 1
            known = c < self.symbols
            high[live[~known]] = low[live[~known]]
            live, c = live[known], c[known]
            low[live] = self.before[c] + self.ranks.rank(c, low[live])
            high[live] = self.before[c] + self.ranks.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: steps back to the next sampled suffix."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.kept[rows[open_]]
            done = open_[here]
            out[done] = self.positions[self.place[rows[done]]] + steps[done]
            open_ = open_[~here]
            c = self.last[rows[open_]]
            rows[open_] = self.before[c] + self.ranks.rank(c, rows[open_])
            steps[open_] += 1
        return out


@dataclass
class Phrases:
    """A block of benchmark windows as symbols: 1.. in order of the words' hashes."""
    words: np.ndarray  # sorted hashes of the block's words
    rows: np.ndarray  # distinct windows, right-aligned
    lengths: np.ndarray
    item_of: list[list] = field(default_factory=list)  # item ids of each window

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each word; 0 for words of no window."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)


def words_of(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, row) of every word."""
    lower = LOWER[flat]
    starts, ends, owner = pieces(lower, offsets, GAP[lower]) if len(flat) else (np.zeros(0, np.int64),) * 3
    return span_hash(lower, starts, ends), starts, ends, owner


def phrases_of(items: list[tuple[object, bytes]], window: int = WINDOW) -> Phrases:
    """All windows of ``window`` words of the items; an item of fewer words, but not none, is one window."""
    flat = np.frombuffer(b"\n".join(t for _, t in items), np.uint8)
    sizes = np.array([len(t) + 1 for _, t in items], np.int64)
    offsets = np.minimum(np.concatenate([[0], np.cumsum(sizes)]), len(flat))
    hashes, _, _, owner = words_of(flat, offsets)
    words = np.unique(hashes)
    symbols = np.searchsorted(words, hashes) + 1
    found: dict[tuple, list] = {}
    bounds = np.searchsorted(owner, np.arange(len(items) + 1))
    for (item, _), low, high in zip(items, bounds[:-1], bounds[1:], strict=True):
        own = tuple(symbols[low:high].tolist())
        for i in range(max(1, len(own) - window + 1) if own else 0):
            found.setdefault(own[i:i + window], []).append(item)
    rows, lengths = np.zeros((len(found), window), np.int64), np.array([len(p) for p in found], np.int64)
    for r, p in enumerate(found):
        rows[r, window - len(p):] = p
    return Phrases(words, rows, lengths, [sorted(set(x), key=str) for x in found.values()])


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``block_words`` words at most (or one item), each read by itself."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-int(size) // (block_words * 2)) or 1  # a word and its gap take two characters at least
    for i in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        yield phrases_of([(r["item_id"], r["text"].encode()) for r in mine.toLocalIterator()], window)


def passages(docs: DataFrame, phrases: Phrases, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, spans, items) of every document against one block of windows.

    A task reads its documents as word symbols, drops stretches that no window
    fits in (a word outside the block, or fewer words than the shortest
    window), and indexes the rest shard by shard.  ``runs`` are the hit word
    positions, ``spans`` the same as code points, merged and half-open.
    """
    shared = docs.sparkSession.sparkContext.broadcast(phrases)

    def search(shard: list[dict], block: Phrases) -> pa.RecordBatch:
        hit_rows = {}
        texts = [d["symbols"] for d in shard if len(d["symbols"])]
        if texts and len(block.rows):
            gaps = [np.append(t, 0) for t in texts]
            text = np.concatenate(gaps)
            index = FMIndex(text)
            low, high = index.search(block.rows, block.lengths)
            found = np.nonzero(high > low)[0]
            number = (high - low)[found]
            rows = np.repeat(low[found], number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            which = np.repeat(found, number)
            at = index.locate(rows)
            owner = np.searchsorted(np.cumsum([len(g) for g in gaps]), at, "right")
            first = np.concatenate([[0], np.cumsum([len(g) for g in gaps])])
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
            for k in range(len(texts)):
                mine = order[cuts[k]:cuts[k + 1]]
                if len(mine):
                    hit_rows[k] = (at[mine] - first[k], which[mine])
        out, k = [], 0
        for d in shard:
            runs, spans, items = [], [], []
            if len(d["symbols"]):
                if k in hit_rows:
                    at, which = hit_rows[k]
                    edge = np.zeros(len(d["symbols"]) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + block.lengths[which], -1)
                    words = d["places"][np.nonzero(np.cumsum(edge[:-1]) > 0)[0]]
                    cut = np.nonzero(np.diff(words) > 1)[0]
                    starts, stops = words[np.concatenate([[0], cut + 1])], words[np.concatenate([cut, [len(words) - 1]])]
                    runs = [{"start": int(a), "stop": int(b) + 1} for a, b in zip(starts, stops, strict=True)]
                    spans = [{"start": int(d["begin"][a]), "stop": int(d["end"][b])} for a, b in zip(starts, stops, strict=True)]
                    items = sorted({str(i) for w in np.unique(which) for i in block.item_of[w]})
                k += 1
            out.append({"doc_id": d["doc_id"], "n_words": d["n_words"], "runs": runs, "spans": spans, "items": items})
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", span), ("spans", span), ("items", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, shard, held = shared.value, [], 0
        for batch in batches:
            for part, flat, offsets in slices(batch, "text"):
                hashes, starts, ends, owner = words_of(flat, offsets)
                symbols = block.symbols(hashes)
                keep = possible(symbols, owner, block.shortest)
                bounds, ids = np.searchsorted(owner, np.arange(part.num_rows + 1)), part.column(0).to_pylist()
                some = np.unique(owner[keep])
                points = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)]) if len(some) else None
                some = set(some.tolist())
                for i in range(part.num_rows):
                    a, b = bounds[i], bounds[i + 1]
                    d = {"doc_id": ids[i], "n_words": int(b - a), "symbols": symbols[:0]}
                    if i in some:
                        kept = np.nonzero(keep[a:b])[0]
                        breaks = np.nonzero(np.diff(kept) > 1)[0] + 1  # a separator between stretches
                        d["symbols"] = np.insert(symbols[a:b][kept], breaks, 0)
                        d["places"] = np.insert(kept, breaks, -1)
                        zero = points[offsets[i]]
                        d["begin"], d["end"] = points[starts[a:b]] - zero, points[ends[a:b]] - zero
                    shard.append(d)
                    held += len(d["symbols"]) + 1
                if held >= shard_words or len(shard) >= 20_000:
                    yield search(shard, block)
                    shard, held = [], 0
        if shard:
            yield search(shard, block)

    span = "array<struct<start:long,stop:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, n_words long, runs {span}, spans {span}, items array<string>")


def possible(symbols: np.ndarray, owner: np.ndarray, shortest: int) -> np.ndarray:
    """Words inside a stretch of at least ``shortest`` block words of one document."""
    keep = np.zeros(len(symbols), bool)
    inside = np.nonzero(symbols > 0)[0]
    if not len(inside) or not shortest:
        return keep
    new = np.concatenate([[True], (np.diff(inside) > 1) | (owner[inside[1:]] != owner[inside[:-1]])])
    size = np.diff(np.append(np.nonzero(new)[0], len(inside)))
    keep[inside[np.repeat(size >= shortest, size)]] = True
    return keep


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["stop"])
        else:
            out.append([s["start"], s["stop"]])
    return [(a, b) for a, b in out]


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, spans, items) of every document against the whole benchmark.

    The benchmark is searched in blocks of bounded size; rows are numbered before the first of several
    blocks, whose runs, spans and items are put together by row and may overlap.
    """
    blocks = phrase_blocks(benchmark, window, block_words)
    head = list(islice(blocks, 2))
    if len(head) == 1:
        return passages(docs, head[0])
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = None
    for block in chain(head, blocks):
        one = passages(rows.select(F.col("__row").alias("doc_id"), "text"), block)
        found = one if found is None else found.unionByName(one)
    found = found.groupBy(F.col("doc_id").alias("__row")).agg(F.max("n_words").alias("n_words"), *[F.flatten(F.collect_list(c)).alias(c) for c in ("runs", "spans", "items")])
    return found.join(rows.select("__row", "doc_id"), "__row").select("doc_id", "n_words", "runs", "spans", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for every document.

    A word is hit if it lies in an occurrence of any window.  ``spans`` are the
    passages to remove as code points, half-open and merged.  Null and empty
    texts have no words; items without words (null texts too) have no window
    and never occur; with an empty benchmark nothing is hit.
    """
    found = occurrences(docs, benchmark, window, block_words)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items_sha256": pa.string(), "contaminated": pa.bool_(),
                 "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))}
        for batch in batches:
            out = []
            for d in batch.to_pylist():
                hit = sum(b - a for a, b in merged(d["runs"]))
                items = sorted(set(d["items"]))
                out.append({"doc_id": d["doc_id"], "n_words": d["n_words"], "n_hit": hit, "n_items": len(items), "contaminated": hit > 0,
                            "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
                            "spans": [{"start": a, "stop": b} for a, b in merged(d["spans"])]})
            yield pa.RecordBatch.from_pylist(out, pa.schema(list(kinds.items())))

    return found.mapInArrow(finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start:long,stop:long>>")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that hold no benchmark window; the columns of the input.

    A document with a run of hit words goes.  What ``contamination`` tells of the hits is not needed, and would
    be a second Python worker beside each task's first.
    """
    hit = occurrences(docs, benchmark, window, block_words).where(F.size("runs") > 0).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti")


def cut_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text) with the removal spans cut out of each text."""
    spans = contamination(docs, benchmark, window).select("doc_id", "spans")
    text = F.col("text")
    kept = F.aggregate("spans", F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
                       lambda acc, s: F.struct(F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("done"), s["stop"].alias("at")),
                       lambda acc: F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int"))))
    return docs.select("doc_id", "text").join(spans, "doc_id").select("doc_id", kept.alias("text"))
