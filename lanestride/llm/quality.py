"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated isotonically."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanestride.llm.arrays import row_sums, slices, span_hash
from lanestride.session import stage

STATISTICS = [
    "log_bytes", "log_words", "space", "upper", "digit", "stop", "symbol", "wide", "newline",
    "word_length", "word_spread", "short_words", "capital_words", "blank_words", "marked_words",
    "distinct_words", "log_distinct", "top_word", "distinct_pairs", "top_pair", "distinct_lines", "top_line", "line_length",
]
FEATURES = 384  # random Fourier features
WIDTH = 3.0  # of the Gaussian kernel, in standardised units
RIDGE = 1e-3  # times the number of rows
CLIP = 5.0  # standardised statistics are held to +-CLIP
GRID = 2048  # cells of the score axis that calibration sums over
SEED = 11
THRESHOLD = 0.3


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


SPACE = _class(" \t\n\v\f\r")
UPPER = np.array([65 <= c <= 90 for c in range(256)])
DIGIT = np.array([48 <= c <= 57 for c in range(256)])
WIDE = np.array([c >= 128 for c in range(256)])
LETTER = UPPER | np.array([97 <= c <= 122 for c in range(256)]) | WIDE
STOP = _class(".,;:!?'\"()-")
SYMBOL = ~(SPACE | LETTER | DIGIT | STOP)


def held_out(key: Column, parts: int = 5, rest: int = 0) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % parts == rest


def spread_of(owner: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(items, distinct items, most frequent item's count) of each row; ``owner`` names the row of each hash."""
    count = np.bincount(owner, minlength=rows)
    distinct, top = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if len(owner):
        key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        run = np.diff(np.append(first, len(key)))
        own = (key[first] >> np.uint64(40)).astype(np.int64)
        distinct = np.bincount(own, minlength=rows)
        np.maximum.at(top, own, run)
    return count, distinct, top


def pieces(flat: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs outside ``gap`` that stay inside a text."""
    inside = ~gap
    opens = inside.copy()
    opens[1:] &= gap[:-1]
    begin = offsets[:-1][np.diff(offsets) > 0]
    opens[begin] = inside[begin]
    closes = inside.copy()
    closes[:-1] &= gap[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    closes[last] = inside[last]
    starts, ends = np.nonzero(opens)[0], np.nonzero(closes)[0] + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def statistics(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; all zero where a text is empty."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((rows, len(STATISTICS)))
    if not len(flat):
        return out
    put = {name: i for i, name in enumerate(STATISTICS)}
    whole = np.maximum(size, 1)
    for name, table in (("space", SPACE), ("upper", UPPER), ("digit", DIGIT), ("stop", STOP), ("symbol", SYMBOL), ("wide", WIDE)):
        out[:, put[name]] = row_sums(table[flat], offsets) / whole
    newline = flat == 10
    out[:, put["newline"]] = row_sums(newline, offsets) / whole
    starts, ends, owner = pieces(flat, offsets, SPACE[flat])
    length = ends - starts
    hashes = span_hash(flat, starts, ends)
    words, distinct, top = spread_of(owner, hashes, rows)
    many = np.maximum(words, 1)
    mean = np.bincount(owner, length, rows) / many
    out[:, put["log_bytes"]], out[:, put["log_words"]] = np.log1p(size), np.log1p(words)
    out[:, put["word_length"]] = np.minimum(mean, 40)
    out[:, put["word_spread"]] = np.minimum(np.sqrt(np.maximum(np.bincount(owner, length.astype(float) ** 2, rows) / many - mean ** 2, 0)), 40)
    out[:, put["short_words"]] = np.bincount(owner, length <= 3, rows) / many
    out[:, put["capital_words"]] = np.bincount(owner, UPPER[flat[starts]], rows) / many
    letters = np.concatenate([[0], np.cumsum(LETTER[flat] | DIGIT[flat])])
    out[:, put["blank_words"]] = np.bincount(owner, letters[ends] == letters[starts], rows) / many
    out[:, put["marked_words"]] = np.bincount(owner, SYMBOL[flat[ends - 1]], rows) / many
    out[:, put["distinct_words"]] = distinct / many
    out[:, put["log_distinct"]] = np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9)
    out[:, put["top_word"]] = top / many
    if len(owner) > 1:
        same = owner[1:] == owner[:-1]
        pair = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[same]
        number, distinct, top = spread_of(owner[1:][same], pair ^ (pair >> np.uint64(31)), rows)
        out[:, put["distinct_pairs"]] = distinct / np.maximum(number, 1)
        out[:, put["top_pair"]] = top / np.maximum(number, 1)
    starts, ends, owner = pieces(flat, offsets, newline)
    lines, distinct, top = spread_of(owner, span_hash(flat, starts, ends), rows)
    out[:, put["distinct_lines"]] = distinct / np.maximum(lines, 1)
    out[:, put["top_line"]] = np.where(lines > 1, top / np.maximum(lines, 1), 0)
    out[:, put["line_length"]] = np.log1p(size / np.maximum(lines, 1))
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<double>) over whole texts; null and empty texts have zeros."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, offsets in slices(batch, "text"):
                found = statistics(flat, offsets)
                values = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * len(STATISTICS), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), values], ["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # statistics x FEATURES
    phase: np.ndarray
    beta: np.ndarray  # FEATURES + 1, the last one the intercept
    steps: np.ndarray  # calibration: raw scores, ascending
    values: np.ndarray  # and what they become, not descending

    def lift(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features: their inner products approximate a Gaussian kernel."""
        z = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.cos(z @ self.weights + self.phase) * np.sqrt(2.0 / self.weights.shape[1])
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.values), 0.0, 1.0)


def stats_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """(Z'Z, Z'y) of (stats, y): each partition sums its own, Spark adds them up row by row of the matrix."""
    size = model.weights.shape[1] + 1
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        seen = False
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                z = shared.value.lift(stats_of(part.column(0)))
                total += z.T @ np.column_stack([z, part.column(1).to_numpy()])
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(list(total.astype("<f8").view(np.uint8).reshape(size, -1).tobytes()[i * 8 * (size + 1):(i + 1) * 8 * (size + 1)] for i in range(size)), pa.binary())],
                ["row", "cells"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(x.as_py(), "<f8") for x in table.column("cells"))
        return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

    summed = rows.select("stats", F.col("y").cast("double")).mapInArrow(run, "row int, cells binary").groupBy("row").applyInArrow(add, "row int, cells binary")
    out = np.zeros((size, size + 1))
    for r in summed.toLocalIterator():  # FEATURES + 1 rows, whatever the corpus holds
        out[r["row"]] = np.frombuffer(r["cells"], "<f8")
    return out[:, :-1], out[:, -1]


def pooled(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic fit: adjacent violators pooled."""
    level: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        level.append([value, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            b, a = level.pop(), level.pop()
            level.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in level]) if level else np.zeros(0)


def fit_quality(labelled: DataFrame, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE) -> QualityModel:
    """A model from (doc_id, stats, y in 0..1).

    One document in four (by hash of its id) calibrates, the others fit the
    ridge scores.  Moments, normal equations and the calibration's sums on a
    grid of scores are all aggregated by Spark; without a labelled row the
    score is 0.5 for every text.
    """
    dims = len(STATISTICS)
    rng = np.random.default_rng(SEED)
    model = QualityModel(np.zeros(dims), np.ones(dims), rng.normal(size=(dims, features)) / width, rng.uniform(0, 2 * np.pi, features),
                         np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    calibrates = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(4)) == 0
    moments = labelled.agg(F.count("*").alias("n"), *[g(F.col("stats")[i]).alias(f"{n}{i}") for i in range(dims) for n, g in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments["n"]:
        return model
    model.mean = np.array([moments[f"m{i}"] for i in range(dims)])
    model.scale = np.maximum([moments[f"s{i}"] for i in range(dims)], 1e-6)
    gram, target = normal_equations(labelled.where(~calibrates), model)
    if gram[-1, -1]:
        penalty = np.full(features + 1, ridge * gram[-1, -1])
        penalty[-1] = 1e-9
        model.beta = np.linalg.solve(gram + np.diag(penalty), target)
    raw = scored(labelled.where(calibrates), model, "raw").join(labelled.where(calibrates).select("doc_id", "y"), "doc_id")
    cell = F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("raw"))) * GRID)
    cells = raw.groupBy(cell.alias("cell")).agg(F.avg("y").alias("y"), F.count("*").alias("w")).orderBy("cell").collect()  # 2 x GRID cells at most
    if cells:
        model.steps = (np.array([r["cell"] for r in cells]) + 0.5) / GRID
        model.values = pooled(np.array([r["y"] for r in cells], float), np.array([r["w"] for r in cells], float))
    return model


def scored(stats: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """(doc_id, ``name``): the calibrated score, or the raw one if ``name`` is ``raw``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                values = (held.raw if name == "raw" else held.score)(stats_of(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], ["doc_id", name])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id long, {name} double")


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Labels are (doc_id, quality); nulls are left out and of repeated labels
    the greatest counts.  Only documents that are not held out teach.  Null
    and empty texts are scored by their (zero) statistics.
    """
    stats = stage(document_statistics(docs))
    taught = labels.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("y"))
    model = fit_quality(stage(stats.where(~held_out(F.col("doc_id"))).join(taught, "doc_id")))
    return scored(stats, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
