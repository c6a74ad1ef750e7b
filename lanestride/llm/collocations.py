"""Collocations from stripes: each prefix keys a counter of the words that follow it."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanestride.llm import words as W
from lanestride.llm.arrays import mixed, slices
from lanestride.session import stage

MOST_WORDS = 5
LEAST_COUNT = 100
SCALE = 1000
SUBSUMED = 100  # percent of a phrase's occurrences that lie in one longer phrase
TOP = 2000
UNKNOWN = "und"
BUCKET_BYTES = 16 << 20
SHARES = 64  # a language's phrases are ranked in so many shares first
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
CUTS = W.byte_table((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
GAPS = CUTS | W.byte_table((0x09, 0x09), (0x20, 0x20))


def tagged(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


class Runs:
    """The distinct runs of up to ``most`` words that begin at the words of a block, ordered by their prefixes, with their counts.

    A run goes as far as its piece does.  ``keys[k]`` is a hash of a run's first
    ``k + 1`` words; runs that are shorter repeat their last one.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, most: int):
        words = W.Words(LOWER[flat], offsets, GAPS)
        self.total = len(words)
        cut = np.cumsum(CUTS[flat], dtype=np.int32)[words.begin] if len(words) else np.zeros(0, np.int32)
        new = np.ones(len(words), bool)
        new[1:] = cut[1:] != cut[:-1]
        new[words.first[:-1][np.diff(words.first) > 0]] = True
        ends = np.append(np.nonzero(new)[0], len(words))[1:] if len(words) else np.zeros(0, np.int64)
        length = np.minimum(most, np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(words)))
        name, begin = words.code.copy(), np.arange(len(words))
        for k in range(1, most):
            more = np.where(length > k, words.code[np.minimum(begin + k, max(0, len(words) - 1))] + 1, 0)
            name, _ = W.named(name, more)
        _, lead, count = np.unique(name, return_index=True, return_counts=True)
        self.words, self.first, self.length, self.count = words, lead, length[lead], count
        self.keys = [mixed(words.hash[lead])]
        raw = words.hash[lead]
        for k in range(1, most):
            longer = self.length > k
            raw = np.where(longer, W.chained(raw, words.hash[np.minimum(lead + k, max(0, len(words) - 1))]), raw)
            self.keys.append(mixed(raw))


def blocks_by_lang(batch: pa.RecordBatch, block_bytes: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for lang, rows in W.batches_of("lang", batch):
        for _, flat, offsets in slices(rows, "text", block_bytes):
            yield lang, flat, offsets


def salt_of(lang: str) -> np.uint64:
    return mixed(np.frombuffer(lang.encode().ljust(-(-max(1, len(lang.encode())) // 8) * 8, b"\0"), "<u8").copy()).sum(dtype=np.uint64)


def prefix_loads(docs: DataFrame, bits: int, block_bytes: int, most: int) -> DataFrame:
    """How many distinct runs of each block begin with the prefixes of each length in each cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, flat, offsets in blocks_by_lang(batch, block_bytes):
                runs = Runs(flat, offsets, most)
                yield W.cell_rows([mixed(k ^ salt_of(lang)) for k in runs.keys[:-1]], bits)

    return docs.mapInArrow(run, W.CELLS)


MESSAGE = "lang string, bucket long, sizes array<int>, data binary"


def messages(docs: DataFrame, bits: int, hot: list[np.ndarray], hot_bits: int, block_bytes: int, most: int) -> DataFrame:
    """A block's runs by language and bucket: their lengths, the prefix lengths that they are dealt by, their counts and their words.

    A run is dealt by its first word, or by as many words as leave no hot
    prefix; so all runs with one prefix of that length meet in one bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, flat, offsets in blocks_by_lang(batch, block_bytes):
                runs = Runs(flat, offsets, most)
                if not len(runs.first):
                    continue
                depth, key = np.full(len(runs.first), most), mixed(runs.keys[-1] ^ salt_of(lang))
                for k in reversed(range(most - 1)):
                    here = mixed(runs.keys[k] ^ salt_of(lang))
                    cool = ~W.is_hot(here, hot[k], hot_bits)
                    depth, key = np.where(cool, k + 1, depth), np.where(cool, here, key)
                bucket = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
                rows: tuple[list, ...] = ([], [], [], [])
                for b in np.nonzero(np.diff(cuts))[0].tolist():
                    mine = order[cuts[b]:cuts[b + 1]]
                    data, sizes = W.pack(runs.length[mine].astype("u1"), depth[mine].astype("u1"), runs.count[mine].astype("<i8"), runs.words.strings(runs.first[mine], runs.length[mine]))
                    for column, x in zip(rows, (lang, b, sizes, data), strict=True):
                        column.append(x)
                kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["lang", "bucket", "sizes", "data"])

    return docs.mapInArrow(run, MESSAGE)


ENTRIES = "lang string, phrase string, words int, n long"


def stripe_entries(sent: DataFrame, most: int, least: int) -> DataFrame:
    """(lang, phrase, words, n): the entries of the stripes of a bucket's runs.

    The stripe of a prefix is the run of counters of the words that follow it;
    its first word's own count is the entry of the empty prefix.  Entries whose
    prefixes are dealt whole to this bucket are final, and left out below
    ``least``; the others (hot prefixes only) are parts, merged elementwise later.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [W.unpack(r["data"], r["sizes"], "u1", "u1", "<i8", "u1") for r in table.select(["sizes", "data"]).to_pylist()]
        length, depth, count, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        length = length.astype(np.int64)
        words = W.Words(flat, np.array([0, len(flat)]), W.byte_table((32, 32)))
        first = np.cumsum(length) - length
        alive, name = np.arange(len(first)), np.zeros(len(first), np.int64)
        phrases, sizes, totals = [], [], []
        for k in range(1, most + 1):
            alive_now = length[alive] >= k
            alive, name = alive[alive_now], name[alive_now]
            if not len(alive):
                break
            name, _ = W.named(name, words.code[first[alive] + k - 1])
            order = np.argsort(name, kind="stable")
            heads = np.nonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]]))[0]
            n = np.add.reduceat(count[alive][order], heads)
            lead = alive[order][heads]
            keep = (n >= least) | (depth[lead] > k)
            at = words.at[first[lead[keep]]], words.at[first[lead[keep]] + k] - 1
            size = at[1] - at[0]
            text = words.flat[W.spread(at[0], size)]
            phrases.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(text)]))
            sizes.append(np.full(len(size), k, np.int32))
            totals.append(n[keep])
        phrase = pa.concat_arrays(phrases).cast(pa.binary()).cast(pa.string())
        return pa.table({"lang": pa.array([key[0].as_py()] * len(phrase), pa.string()), "phrase": phrase, "words": pa.array(np.concatenate(sizes)), "n": pa.array(np.concatenate(totals))})

    return sent.groupBy("lang", "bucket").applyInArrow(run, ENTRIES)


def stripes(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST_COUNT, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = W.BLOCK_BYTES, hot: int = W.HOT) -> DataFrame:
    """(lang, phrase, words, f): every phrase of one to ``most`` words that occurs ``least`` times or more in a language.

    An entry of more than one word is the counter of its last word in the stripe of its prefix.
    """
    rows = tagged(docs)
    size = W.text_bytes(rows)
    cells = W.cell_bits(size // 6)
    tables = W.hot_cells(prefix_loads(rows, cells, block_bytes, most), most - 1, cells, hot)
    sent = messages(rows, W.bucket_bits(most * size, bucket_bytes), tables, cells, block_bytes, most)
    merged = stripe_entries(sent, most, least).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))
    return merged.where(F.col("f") >= least)


def word_totals(docs: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences of each language."""
    text = F.regexp_replace("text", "[^\\x20\\x09.,;:!?\\x0A-\\x0D]+", "\u0001")
    return tagged(docs).groupBy("lang").agg(F.sum(F.length(F.regexp_replace(text, "[^\u0001]", "")).cast("long")).alias("n"))


def collocations(docs: DataFrame, most: int = MOST_WORDS, least: int = LEAST_COUNT, subsumed: int = SUBSUMED, scale: int = SCALE, top: int = TOP, **sizes: int) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``most`` words and occur ``a >= least`` times in a
    language; a null lang is ``und``.  Cut after k words, a phrase whose parts
    occur l and r times scores floor(scale * a * n / (l * r)) among the
    language's n words; the lowest-scoring cut counts, the earliest of equals.
    A phrase of which ``subsumed`` percent or more lie in one longer phrase is
    left out.  Order: score, then a, descending, then the phrase's bytes.  Null and empty
    texts have no words; no documents, or none with a frequent phrase, give no rows.

    Runs of words meet by prefix; a prefix's stripe gives its extensions, the
    prefix's own total stands in the stripe of the shorter prefix, and the greatest entry of a
    stripe (and of the phrases that end alike) tells how much of a phrase lies in a longer one: one
    more word is enough to look at, since a longer phrase occurs no more often than what it contains.
    """
    found = stage(stripes(docs, most, least, **sizes))
    totals = stage(word_totals(docs))
    phrases = found.where("words > 1")
    head, tail = F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)")
    greatest = (phrases.select("lang", head.alias("part"), "f").unionByName(phrases.select("lang", tail.alias("part"), "f"))
                .groupBy("lang", "part").agg(F.max("f").alias("longer")))
    left = (phrases.join(greatest.withColumnRenamed("part", "phrase"), ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("longer") < subsumed * F.col("f"), F.lit(True))).drop("longer"))
    cuts = (left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("before", F.expr("substring_index(phrase, ' ', k)")).withColumn("after", F.expr("substring_index(phrase, ' ', k - words)")))
    part = lambda name, count: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    counted = cuts.join(part("before", "l"), ["lang", "before"]).join(part("after", "r"), ["lang", "after"])
    small = totals.count() <= 1 << 16
    scored = counted.join(F.broadcast(totals) if small else totals, "lang").select(
        "lang", "phrase", F.col("f").alias("a"), "k", "l", "r", "n",
        F.expr(
            f"(CAST(f * {scale} AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))").alias("score"))
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    rows = worst.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("rank") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


_RUN = " UNION ALL ".join(
    f"SELECT lang, doc_id, piece, {k} AS words, " + " || ' ' || ".join(["word", *[f"lead(word, {i}) OVER o" for i in range(1, k)]]) + " AS phrase FROM w WINDOW o AS (PARTITION BY doc_id, piece ORDER BY pos)"
    for k in range(1, MOST_WORDS + 1))
#: For rows with unique, non-null doc_ids.
COLLOCATION_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT doc_id, lang, unnest(ps) AS t, unnest(range(len(ps))) AS piece FROM d),
s AS (SELECT doc_id, lang, piece, [x FOR x IN string_split_regex(t, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
w AS (SELECT doc_id, lang, piece, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM s),
f AS (SELECT lang, words, phrase, count(*) AS f FROM ({_RUN}) WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
t AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE words > 1),
g AS (SELECT a.lang, a.phrase, a.f, a.words, a.ws FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.lang = a.lang AND b.words > a.words
  AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ') AND {SUBSUMED} * a.f <= 100 * b.f)),
k AS (SELECT lang, phrase, f, ws, unnest(range(1, words)) AS k FROM g),
x AS (SELECT k.lang, k.phrase, k.f AS a, k, l.f AS l, r.f AS r, t.n, CAST(({SCALE}::HUGEINT * k.f * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score FROM k
  JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(ws[1:k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(ws[k + 1:], ' ') JOIN t ON t.lang = k.lang),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM x),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM y WHERE nth = 1)
SELECT * FROM z WHERE rank <= {TOP}
"""
