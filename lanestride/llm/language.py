"""Language identification with a bit-sliced Bloom filter of character n-grams."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import SLICE_BYTES, mixed, row_sums, slices

GRAM = 5  # bytes
SLOTS = 1 << 20  # rows of the filter; each holds one bit for each language
PROBES = 3
FIT_DOCS = 4000  # labelled documents of each language that the filter is fitted on (expected number of a hashed sample)
LEAST_DOCS = 3  # documents of a language that must contain an n-gram before the language owns it; see least_of
FEW_DOCS = 10  # labelled documents of a language for each of these; a language with fewer needs 1
LEAST_KNOWN = 0.02  # share of a text's n-grams below which it counts as unknown
SCRIPT_SHARE = 0.1  # of a language's sampled documents that must be mainly in a script before it was learned
WORD = 64  # languages that one word of a slot's mask holds
UNKNOWN = "und"
#: Bytes of a text after A-Z are lower-cased and ASCII characters that are no letters become spaces.
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def held_out(key: Column, parts: int = 4, rest: int = 2) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % parts == rest


def grams(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n-gram that starts at each byte, whether it counts): inside one text, without two spaces in a row."""
    size = len(flat) - GRAM + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    folded = FOLD[flat]
    packed = np.zeros(size, np.uint64)
    for i in range(GRAM):
        packed = (packed << np.uint64(8)) | folded[i:i + size]
    blank = folded == 32
    twice = np.zeros(len(flat), np.uint8)
    twice[:-1] = blank[:-1] & blank[1:]
    bad = np.zeros(size, np.uint8)
    for i in range(GRAM - 1):
        bad |= twice[i:i + size]
    for end in offsets[1:-1]:  # n-grams that would reach over the end of a text
        bad[max(0, end - GRAM + 1):end] = 1
    return mixed(packed), bad == 0


def padded(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before and after each, so that words at the ends count like others."""
    sizes = np.diff(offsets)
    bounds = offsets + 2 * np.arange(len(offsets))
    out = np.full(len(flat) + 2 * len(sizes), 32, np.uint8)
    out[np.arange(len(flat)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)] = flat
    return out, bounds


def probes(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(PROBES)]


def script_of(text: str) -> int:
    """The script that most letters of a text are in, as a number; -1 without letters.

    Code points are grouped by runs of 128, with all Latin, all Han and all Hangul as one group each.
    """
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (code >= 0xAA) & ~((code >= 0x2000) & (code < 0x2C00)) & ~((code >= 0x3000) & (code < 0x3040)) & ~((code >= 0x1F000) & (code < 0x20000))
    letter |= ((code | 32) >= 97) & ((code | 32) <= 122)
    code = code[letter]
    if not len(code):
        return -1
    group = code >> 7
    group[(code < 0x250) | ((code >= 0x1E00) & (code < 0x1F00))] = 0
    group[((code >= 0x3400) & (code < 0xA000)) | ((code >= 0xF900) & (code < 0xFB00)) | (code >= 0x20000)] = 0x4E00 >> 7
    group[(code >= 0xAC00) & (code < 0xD7B0)] = 0xAC00 >> 7
    return int(np.bincount(group).argmax())


@dataclass
class LanguageFilter:
    languages: list[str]  # bit i of a slot stands for languages[i]
    slots: np.ndarray  # unsigned masks: (SLOTS,), or (SLOTS, words) with more languages than a word has bits
    chance: np.ndarray  # probability that an n-gram foreign to a language passes its filter
    sizes: list[int] | None = None  # labelled documents of each language

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Mask of all languages that contain each n-gram."""
        first, *more = probes(hashes, len(self.slots))
        mask = self.slots[first]
        for at in more:
            mask &= self.slots[at]
        return mask

    def holds(self, mask: np.ndarray, i: int) -> np.ndarray:
        """Bit of language i in each mask."""
        word = mask if mask.ndim == 1 else mask[:, i // WORD]
        return (word >> word.dtype.type(i % WORD)) & word.dtype.type(1)

    def decide(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(index of the best language, its score, share of n-grams that it knows, n-grams) for each text.

        A language's popcount is its number of n-grams found, less the false
        positives expected among the rest: (found - n * chance) / (1 - chance).
        The score is the best language's share of the corrected popcounts; 0
        when nothing is found (the first language, the most frequent one, is then taken).
        """
        flat, offsets = padded(flat, offsets)
        counts = np.zeros((len(self.languages), len(offsets) - 1))
        total = np.zeros(len(offsets) - 1)
        step = max(1 << 10, SLICE_BYTES // (self.slots.shape[1] if self.slots.ndim > 1 else 1))
        for low in range(0, max(1, len(flat)), step):  # a very long text goes in pieces that overlap by an n-gram
            high = min(len(flat), low + step + GRAM - 1)
            here = np.clip(offsets, low, high) - low
            hashes, valid = grams(flat[low:high], here)
            ends = np.minimum(here, len(hashes))
            mask = self.lookup(hashes)
            mask[~valid] = 0
            total += row_sums(valid, ends)
            for i in range(len(self.languages)):
                counts[i] += row_sums(self.holds(mask, i), ends)
        chance = self.chance[:, None]
        fixed = np.clip((counts - total * chance) / np.maximum(1 - chance, 1e-9), 0, None)
        whole = fixed.sum(axis=0)
        best = fixed.argmax(axis=0)
        score = np.where(whole > 0, fixed.max(axis=0) / np.maximum(whole, 1e-9), 0.0)
        known = np.where(total > 0, fixed.max(axis=0) / np.maximum(total, 1), 0.0)
        return best, np.clip(score, 0, 1), np.clip(known, 0, 1), total.astype(np.int64)


def sampled(docs: DataFrame, languages: list[str], sizes: list[int], fit_docs: int = FIT_DOCS) -> DataFrame:
    """(lang, text): documents drawn by their hashed id, about ``fit_docs`` of each language, which is told by its number."""
    place = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])
    rate = F.create_map(*[F.lit(x) for lang, size in zip(languages, sizes, strict=True) for x in (lang, min(1.0, fit_docs / size))])
    draw = F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 11) / F.lit(float(1 << 53))
    known = docs.where("lang is not null and text is not null")
    return known.where(draw < rate[F.col("lang")]).select(place[F.col("lang")].alias("lang"), "text")


def least_of(size: int, least_docs: int = LEAST_DOCS) -> int:
    """Documents that must contain an n-gram before a language of ``size`` labelled documents owns it."""
    return max(1, min(least_docs, size // FEW_DOCS))


def learned_scripts(docs: DataFrame, model: LanguageFilter) -> list[int]:
    """Scripts of the documents that the languages of the filter were learned from."""
    taught = {i: size for i, size in enumerate(model.sizes) if model.chance[i] > 0}
    if not taught:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [script_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32())], ["lang", "script"])

    rows = sampled(docs, model.languages, model.sizes).mapInArrow(run, "lang int, script int").groupBy("lang", "script").count().collect()
    whole: dict[int, int] = {}
    for r in rows:
        whole[r["lang"]] = whole.get(r["lang"], 0) + r["count"]
    return sorted({r["script"] for r in rows if r["lang"] in taught and r["script"] >= 0
                   and r["count"] >= max(least_of(taught[r["lang"]]), SCRIPT_SHARE * whole[r["lang"]])})


def fit_languages(docs: DataFrame, fit_docs: int = FIT_DOCS, slots: int = SLOTS, least_docs: int = LEAST_DOCS) -> LanguageFilter:
    """The filter learned from the ``text`` and non-null ``lang`` of a bounded sample of ``docs``.

    The sample takes the documents whose hashed id falls below a rate that
    gives about ``fit_docs`` of each language.  Each task reduces its texts to
    distinct n-grams with document counts; sums and the masks of the slots are
    aggregated by Spark, so that the driver receives at most ``slots`` masks for
    each 64 languages.
    """
    known = docs.where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    dtype = np.uint8 if len(languages) <= 8 else np.uint64
    words = max(1, -(-len(languages) // WORD))
    table, fill = np.zeros((slots, words), dtype), np.zeros(len(languages))
    if languages:
        sample = sampled(docs, languages, [sizes[x] for x in languages], fit_docs)
        least = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (i, least_of(sizes[lang], least_docs))])

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, flat, offsets in slices(batch, "text"):
                    lang = part.column(0).to_numpy()
                    flat, offsets = padded(flat, offsets)
                    hashes, valid = grams(flat, offsets)
                    owner = np.repeat(np.arange(len(lang)), np.diff(offsets))[:len(hashes)]
                    hashes, owner = hashes[valid], owner[valid]
                    order = np.lexsort((owner, hashes))
                    hashes, owner = hashes[order], owner[order]
                    if not len(hashes):
                        continue
                    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
                    hashes, owner = hashes[new], lang[owner[new]]
                    order = np.lexsort((owner, hashes))
                    hashes, owner = hashes[order], owner[order]
                    first = np.nonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]))[0]
                    docs_of = np.diff(np.append(first, len(hashes)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(owner[first].astype(np.int32)), pa.array(hashes[first].view(np.int64)), pa.array(docs_of.astype(np.int64))],
                        ["lang", "gram", "docs"])

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = probes(batch.column(1).to_numpy().view(np.uint64), slots)
                word, bit = np.divmod(batch.column(0).to_numpy().astype(np.uint64), np.uint64(WORD))
                bits = (np.uint64(1) << bit).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at)), pa.array(np.tile(word.astype(np.int32), len(at))), pa.array(np.tile(bits, len(at)))],
                                                 ["slot", "word", "mask"])

        owned = (sample.mapInArrow(count, "lang int, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
                 .where(F.col("docs") >= least[F.col("lang")]).select("lang", "gram"))
        rows = owned.mapInArrow(spread, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
        table[rows.column("slot").to_numpy(), rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64).astype(dtype)
    model = LanguageFilter(languages, table if words > 1 else table.ravel(), fill, [sizes[x] for x in languages])
    model.chance = np.array([model.holds(model.slots, i).mean() for i in range(len(languages))]) ** PROBES
    return model


def identify(docs: DataFrame, model: LanguageFilter, least_known: float = LEAST_KNOWN) -> DataFrame:
    """(doc_id, lang_pred, score, known, n_grams, letters, script) for every whole text.

    ``lang_pred`` is ``und`` (score 0) if the text is null or has no letter,
    or if no language was learned; otherwise a learned language.  ``known`` is
    the share of the text's n-grams that the language contains.  ``letters``
    tells whether the text has any, ``script`` its script where fewer than
    ``least_known`` of the n-grams are known and null elsewhere.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS masks for each 64 languages, whatever the corpus holds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        names = np.array([*held.languages, UNKNOWN], object)
        letter = np.array([65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])
        for batch in batches:
            for part, flat, offsets in slices(batch, "text"):
                has = row_sums(letter[flat], offsets) > 0
                for i in np.nonzero(~has & (np.diff(offsets) > 0))[0]:
                    has[i] = any(map(str.isalpha, part.column(1)[int(i)].as_py()))
                letters = has
                if held.languages:
                    best, score, known, total = held.decide(flat, offsets)
                    script = [script_of(part.column(1)[i].as_py()) if h and k < least_known else None for i, (h, k) in enumerate(zip(has, known, strict=True))]
                else:
                    score = known = total = np.zeros(len(has))
                    best, has, script = np.zeros(len(has), np.int64), has & False, [None] * len(has)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names[np.where(has, best, len(names) - 1)], pa.string()), pa.array(np.where(has, score, 0.0)), pa.array(np.where(has, known, 0.0)),
                     pa.array(total.astype(np.int64)), pa.array(letters), pa.array(script, pa.int32())],
                    ["doc_id", "lang_pred", "score", "known", "n_grams", "letters", "script"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, known double, n_grams long, letters boolean, script int")


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known, n_grams: learned from the documents that are not held out."""
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known", "n_grams")


def keep_known_languages(docs: DataFrame, least_known: float = LEAST_KNOWN, least_grams: int = 20) -> DataFrame:
    """Documents that nothing speaks against; the columns of the input.

    Those without a letter go, and those of ``least_grams`` n-grams or more of
    which less than ``least_known`` is in any language, if a language in their
    script was learned.  The filter is learned from all labelled documents, so
    that a rare language has all that there is.
    """
    model = fit_languages(docs)
    against = F.col("script").isin(learned_scripts(docs, model)) & (F.col("n_grams") >= least_grams)
    rejected = identify(docs, model, least_known).where(~F.col("letters") | F.coalesce(against, F.lit(False))).select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti")
