"""Repeated word windows removed; windows meet as super-k-mers, dealt by their minimisers."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.llm import words as W
from lanestride.llm.arrays import STEP, mixed, powers, slices

WINDOW = 13  # words of a repeated window
MINIMISER = 3  # words whose hash places a window
BUCKET_BYTES = 16 << 20  # packed strings that one bucket receives, about
PART_BITS = 3  # a bucket is sorted in so many bits' parts, one after the other
PLACE_BITS = 20
CHUNK = 1 << 18  # starts looked at together
SALT = np.uint64(0xA0761D6478BD642F)
GAPS = W.byte_table((0x09, 0x0D), (0x20, 0x20))
STRING_BYTES = 120  # of a packed string, about


def window_starts(first: np.ndarray, size: int, window: int) -> np.ndarray:
    """Whether a whole window of one text begins at each word."""
    edge = np.zeros(size + 1, np.int64)
    long = np.diff(first) >= window
    np.add.at(edge, first[:-1][long], 1)
    np.add.at(edge, first[1:][long] - window + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def super_kmers(words: W.Words, window: int = WINDOW, minimiser: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, number of starts, 64-bit minimiser value) of each run of windows with one minimiser.

    The minimiser of a window is the place of the run of ``minimiser`` words in
    it with the least hash, the leftmost of equals: a function of the window's
    words alone, so equal windows have equal values wherever they stand.
    """
    valid = window_starts(words.first, len(words), window)
    width = window - minimiser + 1
    low_bits = np.uint64((1 << PLACE_BITS) - 1)
    firsts, counts, values = [], [], []
    for low in range(0, len(words), CHUNK):
        starts = np.nonzero(valid[low:low + CHUNK])[0]
        if not len(starts):
            continue
        word = words.hash[low:low + CHUNK + window - 1]
        gram = word[:len(word) - minimiser + 1]
        for i in range(1, minimiser):
            gram = W.chained(gram, word[i:len(word) - minimiser + 1 + i])
        least = (gram & ~low_bits) | np.arange(len(gram), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:span - width], least[width - span:])
        at = (least[starts] & low_bits).astype(np.int64)
        begin = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(starts) > 1)]))[0]
        firsts.append(starts[begin] + low)
        counts.append(np.diff(np.append(begin, len(starts))))
        values.append(mixed(gram[at[begin]] * SALT))
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(values)


def single_windows(words: W.Words, first: np.ndarray, count: np.ndarray, value: np.ndarray, hot: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that ``hot`` marks cut into their windows, each with the hash of all of its words as its value."""
    if not hot.any():
        return first, count, value
    start = W.spread(first[hot], count[hot])
    whole = words.hash[start]
    for i in range(1, window):
        whole = W.chained(whole, words.hash[start + i])
    return (np.concatenate([first[~hot], start]), np.concatenate([count[~hot], np.ones(len(start), np.int64)]), np.concatenate([value[~hot], mixed(whole * SALT)]))


class Distinct:
    """The distinct strings of a block in the order of their values; equality is decided by their words."""

    def __init__(self, words: W.Words, first: np.ndarray, count: np.ndarray, value: np.ndarray, window: int):
        ends = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words.hash * powers(len(words) + 1)[:-1], out=ends[1:])
        scale = powers(len(words) + 1, np.uint64(pow(int(STEP), -1, 1 << 64)))
        content = mixed((ends[first + count + window - 1] - ends[first]) * scale[first] + value + count.astype(np.uint64))
        order = np.lexsort((content, value))
        self.first, self.count, self.value = first[order], count[order], value[order]
        same = np.zeros(len(order), bool)
        if len(order) > 1:
            near = np.nonzero((content[order][1:] == content[order][:-1]) & (self.count[1:] == self.count[:-1]))[0]
            size = self.count[near] + window - 1
            a, b = W.spread(self.first[near], size), W.spread(self.first[near + 1], size)
            unlike = np.concatenate([[0], np.cumsum(words.code[a] != words.code[b])])
            ends_at = np.cumsum(size)
            same[near + 1] = unlike[ends_at] == unlike[ends_at - size]
        self.lead = np.nonzero(~same)[0]
        self.copies = np.diff(np.append(self.lead, len(order)))


def block_words(batch: pa.RecordBatch, block_bytes: int) -> Iterator[tuple[pa.RecordBatch, W.Words]]:
    for part, flat, offsets in slices(batch, "text", block_bytes):
        yield part, W.Words(flat, offsets, GAPS)


def minimiser_loads(docs: DataFrame, bits: int, block_bytes: int, window: int, minimiser: int) -> DataFrame:
    """How many distinct strings of each block fall into each cell of minimisers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in block_words(batch, block_bytes):
                kmers = Distinct(words, *super_kmers(words, window, minimiser), window)
                yield W.cell_rows([kmers.value[kmers.lead]], bits)

    return docs.select("text").mapInArrow(run, W.CELLS)


MESSAGE = "bucket long, parts array<int>, sizes array<int>, data binary"


def messages(docs: DataFrame, bits: int, hot: np.ndarray, hot_bits: int, block_bytes: int, window: int, minimiser: int) -> DataFrame:
    """For each block and bucket the block's distinct strings, each with the places that it has there.

    ``data`` holds, one after the other: starts of each string, places of each string,
    doc_ids and variants and first words of the places, and the strings.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in block_words(batch, block_bytes):
                first, count, value = super_kmers(words, window, minimiser)
                kmers = Distinct(words, *single_windows(words, first, count, value, W.is_hot(value, hot, hot_bits), window), window)
                if not len(kmers.lead):
                    continue
                ids = part.column(part.schema.get_field_index("doc_id")).to_numpy()
                variants = part.column(part.schema.get_field_index("variant")).to_numpy()
                doc = np.searchsorted(words.first, kmers.first, "right") - 1
                value = kmers.value[kmers.lead]
                cut = np.searchsorted(value >> np.uint64(64 - bits - PART_BITS), np.arange((1 << (bits + PART_BITS)) + 1, dtype=np.uint64))
                rows: tuple[list, ...] = ([], [], [], [])
                for bucket in range(1 << bits):
                    cuts = cut[bucket << PART_BITS:((bucket + 1) << PART_BITS) + 1]
                    if cuts[0] == cuts[-1]:
                        continue
                    # the strings of a part go in the order of the text, which keeps doc_ids and places close
                    order = np.lexsort((kmers.first[kmers.lead[cuts[0]:cuts[-1]]], np.repeat(np.arange(1 << PART_BITS), np.diff(cuts)))) + cuts[0]
                    lead, copies = kmers.lead[order], kmers.copies[order]
                    place = W.spread(lead, copies)
                    of = doc[place]
                    data, sizes = W.pack(kmers.count[lead].astype("u1"), copies.astype("<i4"), np.diff(ids[of], prepend=0).astype("<i8"), variants[of].astype("<i8"),
                                         (kmers.first[place] - words.first[of]).astype("<i4"), words.strings(kmers.first[lead], kmers.count[lead] + window - 1))
                    for column, x in zip(rows, (bucket, np.diff(cuts).tolist(), sizes, data), strict=True):
                        column.append(x)
                kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["bucket", "parts", "sizes", "data"])

    return docs.mapInArrow(run, MESSAGE)


def window_names(code: np.ndarray, window: int) -> np.ndarray:
    """Number of the ``window`` words from each place on; equal windows and only those have equal numbers.

    Names of spans that double are sorted, and spans are put together as the binary digits of ``window`` say.
    """
    name, span, out, done = code, 1, None, 0
    while True:
        if window & span:
            if out is None:
                out = name
            else:
                size = max(0, len(code) - done - span + 1)
                out = W.named(out[:size], name[done:done + size])[0]
            done += span
        span <<= 1
        if span > window:
            return out
        half = span >> 1
        size = max(0, len(code) - span + 1)
        name = W.named(name[:size], name[half:half + size])[0]


def repeated_starts(count: np.ndarray, least: np.ndarray, flat: np.ndarray, window: int) -> np.ndarray:
    """The smallest doc_id with the window of each start of each string (``count`` starts, ``least`` doc_id that has the string)."""
    words = W.Words(flat, np.array([0, len(flat)]), GAPS)
    name = window_names(words.code, window)
    size = count + window - 1
    starts = name[W.spread(np.cumsum(size) - size, count)]
    holder = np.full(int(name.max()) + 1 if len(name) else 0, np.iinfo(np.int64).max)
    np.minimum.at(holder, starts, np.repeat(least, count))
    return holder[starts]


SPANS = "doc_id long, variant long, first int, stop int"


def removals(sent: DataFrame, window: int) -> DataFrame:
    """(doc_id, variant, first, stop): the words that windows of a string remove from a document, a row for each place of a string."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ready = []
        for row in table.to_pylist():
            count, copies, ids, variants, at, flat = W.unpack(row["data"], row["sizes"], "u1", "<i4", "<i8", "<i8", "<i4", "u1")
            count, copies, ids = count.astype(np.int64), copies.astype(np.int64), np.cumsum(ids)
            where = np.concatenate([[0], np.cumsum(copies)])
            spaces = np.nonzero(flat == 32)[0]
            ends = np.concatenate([[0], spaces[np.cumsum(count + window - 1) - 1] + 1])
            ready.append((np.concatenate([[0], np.cumsum(row["parts"])]), count, copies, ids, variants, at, flat, where, np.minimum.reduceat(ids, where[:-1]), ends))
        found: list[tuple[np.ndarray, ...]] = []
        for part in range(1 << PART_BITS):
            mine = [(r, int(r[0][part]), int(r[0][part + 1])) for r in ready if r[0][part + 1] > r[0][part]]
            if not mine:
                continue
            join = lambda pick: np.concatenate([pick(r, a, b) for r, a, b in mine])
            count, copies = join(lambda r, a, b: r[1][a:b]), join(lambda r, a, b: r[2][a:b])
            smallest = repeated_starts(count, join(lambda r, a, b: r[8][a:b]), join(lambda r, a, b: r[6][r[9][a]:r[9][b]]), window)
            place = [join(lambda r, a, b, i=i: r[i][r[7][a]:r[7][b]]) for i in (3, 4, 5)]
            each = np.repeat(count, copies)  # starts of each place
            of_start = W.spread(np.repeat(np.cumsum(count) - count, copies), each)
            holder = np.repeat(np.arange(len(each)), each)
            gone = smallest[of_start] < place[0][holder]
            inside = (np.arange(len(holder)) - np.repeat(np.cumsum(each) - each, each))[gone]
            holder = holder[gone]
            new = np.ones(len(holder), bool)
            new[1:] = (holder[1:] != holder[:-1]) | (inside[1:] != inside[:-1] + 1)
            begin = np.nonzero(new)[0]
            last = np.append(begin[1:], len(holder)) - 1 if len(begin) else begin
            at = place[2][holder[begin]].astype(np.int64)
            found.append((place[0][holder[begin]], place[1][holder[begin]], at + inside[begin], at + inside[last] + window))
        columns = [np.concatenate([f[i] for f in found]) for i in range(4)]
        kinds = {"doc_id": pa.int64(), "variant": pa.int64(), "first": pa.int32(), "stop": pa.int32()}
        return pa.table({n: pa.array(c.astype(k.to_pandas_dtype()), k) for (n, k), c in zip(kinds.items(), columns, strict=True)})

    return sent.groupBy("bucket").applyInArrow(run, SPANS)


def remaining(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    """The result row of each document, from its text and the spans to remove."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words in block_words(batch, BLOCK_SLICE):
                edge = np.zeros(len(words) + 1, np.int64)
                spans = part.column(part.schema.get_field_index("spans"))
                shift = np.repeat(words.first[:-1], pc.fill_null(pc.list_value_length(spans), 0).to_numpy())
                first, stop = (spans.flatten().field(n).to_numpy() + shift for n in ("first", "stop"))
                edge[:] += np.bincount(first, minlength=len(edge)) - np.bincount(stop, minlength=len(edge))
                gone = np.cumsum(edge[:-1]) > 0
                n = np.diff(words.first)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
                kept = words.flat[np.repeat(~gone, np.diff(words.at))].tobytes()
                ends = np.concatenate([[0], np.cumsum(np.where(gone, 0, np.diff(words.at)))])[words.first]
                texts = [kept[a:b][:-1] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                columns = [part.column(part.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                           pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([t.decode() for t in texts], pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


BLOCK_SLICE = 1 << 20


def with_variants(docs: DataFrame) -> DataFrame:
    """(doc_id, variant, text): variant tells apart rows that repeat a doc_id with another text, and is 0 elsewhere."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.xxhash64("text")
    several = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(digest).alias("a"), F.max(digest).alias("b")).where("a <> b").select("doc_id")
    if several.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("variant"), "text")
    return (rows.join(several.withColumn("_several", F.lit(True)), "doc_id", "left")
            .select("doc_id", F.when(F.col("_several"), digest).otherwise(F.lit(0).cast("long")).alias("variant"), "text"))


def remove_repeated_windows(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES,
                            block_bytes: int = W.BLOCK_BYTES, hot: int = W.HOT) -> DataFrame:
    """Every document less each word that a window of an earlier document covers: doc_id, n_words, n_removed, kept_sha256, and ``kept`` with ``with_text``.

    A window is ``window`` consecutive words; windows are judged on the input, and
    "earlier" is a smaller doc_id.  Rows that repeat a doc_id do not remove from
    each other.  A row with a null doc_id has no place in that order: it keeps
    all of its words and removes none.  Null and empty texts have no words.  Each
    input row gives one row; further columns of the input are not looked at.

    Consecutive windows that share a minimiser travel as one packed string to
    the minimiser's bucket, where sorting names all windows exactly; a block of
    documents sends each distinct string once, with its places.  A minimiser
    around which more than ``hot`` strings stand (a phrase in ever different
    surroundings) is known from a first count of cells; its windows travel one
    by one, dealt by all of their words.  Hashes deal and order only: strings
    and windows are equal when their words are.
    """
    rows = with_variants(docs)
    known = rows.where("doc_id is not null")
    size = W.text_bytes(known)
    cells = W.cell_bits(size // 36)
    hot_table = W.hot_cells(minimiser_loads(known, cells, block_bytes, window, minimiser), 1, cells, hot)[0]
    sent = messages(known, W.bucket_bits(3 * size, bucket_bytes), hot_table, cells, block_bytes, window, minimiser)
    spans = removals(sent, window).groupBy("doc_id", "variant").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    return remaining(rows.join(spans, ["doc_id", "variant"], "left").select("doc_id", "text", "spans"), window, with_text)


#: Rows with unique doc_ids; a null doc_id keeps all words.
WINDOW_SQL = r"""
WITH d AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d),
k AS (SELECT doc_id, pos, word, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o
  || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o || ' ' || lead(word, 7) OVER o || ' ' || lead(word, 8) OVER o
  || ' ' || lead(word, 9) OVER o || ' ' || lead(word, 10) OVER o || ' ' || lead(word, 11) OVER o || ' ' || lead(word, 12) OVER o AS win
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
m AS (SELECT doc_id, pos, word, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM k),
g AS (SELECT doc_id, pos, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM m),
r AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""
