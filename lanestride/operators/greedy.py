"""Greedy selection along a line without a walk: successor pointers, doubled inside chunks and between them."""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from lanestride.operators.spread import ordered_index
from lanestride.session import stage

CHUNK = 1 << 15  # positions whose pointers one row holds


def _reach(at: Column, gap: float) -> Column:
    """The least double x with x - at >= gap, in floating-point arithmetic."""
    near = at + F.lit(float(gap))
    step = F.abs(near) * F.lit(1.5 * 2.0 ** -53)
    lower = near - step
    return (F.when(near - at < gap, near + step).when(lower - at >= gap, lower).otherwise(near))


def successors(points: DataFrame, keys: Sequence[str], place: str, gap: float) -> DataFrame:
    """Distinct positions with their dense index ``_i`` per key and ``_s``, the index of the first one at least ``gap`` later.

    Positions and their probes (the position plus the gap) are put in one order
    and counted; a probe has as many positions before it as its successor's
    index.  ``_s`` of the last ones is the number of positions.
    """
    keys = list(keys)
    real = isinstance(points.schema[place].dataType, (DoubleType, FloatType))
    at = F.col(place).cast("double") if real else F.col(place).cast("bigint")
    probe = _reach(at, gap) if real else at + F.lit(math.ceil(gap)).cast("bigint")
    both = (points.select(*keys, at.alias("_v"), F.lit(1).alias("_n"), F.col(place))
            .unionByName(points.select(*keys, probe.alias("_v"), F.lit(0).alias("_n"), F.col(place))))
    counted = ordered_index(both, keys, F.floor(F.col("_v") / F.lit(float(gap))).cast("bigint"), ["_v", "_n"], "_at", weight="_n")
    own, reached = F.max(F.when(F.col("_n") == 1, F.col("_at"))), F.max(F.when(F.col("_n") == 0, F.col("_at")))
    return (counted.groupBy(*keys, place).agg(own.cast("bigint").alias("_i"), reached.cast("bigint").alias("_s"))
            .withColumn("_s", F.greatest("_s", F.col("_i") + 1)))


class _Chunks:
    """The pointers of a batch of chunks as one flat array; N stands for everything outside a chunk."""

    def __init__(self, batch: pa.RecordBatch):
        lists = batch.column(batch.schema.get_field_index("_s"))
        self.offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.s = lists.flatten().to_numpy(zero_copy_only=False)
        self.size = len(self.s)
        first = batch.column(batch.schema.get_field_index("_first")).to_numpy()
        self.group = np.repeat(np.arange(len(first)), np.diff(self.offsets))
        self.shift = self.offsets[:-1] - first
        here = self.s + self.shift[self.group]
        self.inside = here < self.offsets[1:][self.group]
        self.next = np.where(self.inside, here, self.size)

    def exits(self) -> np.ndarray:
        """For each position the first one of its walk that lies outside its chunk."""
        last = np.where(self.inside, self.next, np.arange(self.size))
        while True:
            further = last[last]
            if (further == last).all():
                return self.s[last]
            last = further

    def walk(self, entries: np.ndarray) -> np.ndarray:
        """Which positions the walks from one entry in each chunk meet."""
        met = np.zeros(self.size + 1, bool)
        met[entries + self.shift] = True
        jump = np.append(self.next, self.size)
        while (jump < self.size).any():
            met[jump[met]] = True
            jump = jump[jump]
        return met[:self.size]


def _keyed(batch: pa.RecordBatch, keys: list[str], rows: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
    """Key columns of the given rows of a batch beside other columns."""
    taken = [batch.column(batch.schema.get_field_index(k)).take(pa.array(rows)) for k in keys]
    return pa.RecordBatch.from_arrays([*taken, *columns.values()], [*keys, *columns])


def min_gap(rows: DataFrame, keys: Sequence[str], place: str, gap: float, chunk: int = CHUNK) -> DataFrame:
    """Greedy keep-first positions: drop those closer than ``gap`` to the last *kept* one.

    Equal positions count once; positions that are null or not a number, and
    rows with a null key, are left out.  The kept positions are the walk from a
    key's first position along the successor pointers.  A row holds the pointers of ``chunk``
    positions; a walk inside it is found by doubling its pointers.  Where a key
    has more chunks, each chunk's map from the positions where a walk may enter it to those
    where it leaves is doubled in the same way, between rows: the number of rounds is the
    logarithm of the number of chunks, and no task sees more of a key than a chunk.
    """
    keys = list(keys)
    kind = rows.schema[place].dataType
    points = rows.select(*keys, place).where(F.col(place).isNotNull() & ~F.isnan(F.col(place).cast("double"))).dropna(subset=keys).distinct()
    if gap <= 0:
        return points
    points = stage(points)  # four branches read them; what is behind ``rows`` runs once
    own = F.floor(F.col("_i") / chunk).cast("bigint")
    packed = (successors(points, keys, place, gap).groupBy(*keys, own.alias("_chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("_i", "_s", place))).alias("_rows"))
              .select(*keys, "_chunk", F.expr("_rows[0]._i").alias("_first"), F.col("_rows._s").alias("_s"), F.col(f"_rows.{place}").alias("_at")))
    packed = stage(packed)
    types = ", ".join(f"`{k}` {dict(packed.dtypes)[k]}" for k in keys)
    several = (packed.agg(F.max("_chunk")).first()[0] or 0) > 0
    entered = packed.withColumn("_entry", F.col("_first"))
    if several:
        visited = _visited(packed, keys, types, chunk)
        entered = packed.join(visited.withColumn("_chunk", own).withColumnRenamed("_i", "_entry"), [*keys, "_chunk"])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = _Chunks(batch)
            met = np.nonzero(chunks.walk(batch.column(batch.schema.get_field_index("_entry")).to_numpy()))[0]
            at = batch.column(batch.schema.get_field_index("_at")).flatten().take(pa.array(met))
            yield _keyed(batch, keys, chunks.group[met], at=at)

    out = entered.select(*keys, "_first", "_s", "_at", "_entry").mapInArrow(kept, f"{types}, at {kind.simpleString()}")
    return out.select(*keys, F.col("at").alias(place))


def _visited(packed: DataFrame, keys: list[str], types: str, chunk: int) -> DataFrame:
    """(keys, _i): the position at which each key's walk enters each of its chunks."""
    def leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = _Chunks(batch)
            exits = chunks.exits()
            new = np.ones(len(exits), bool)
            new[1:] = (exits[1:] != exits[:-1]) | (chunks.group[1:] != chunks.group[:-1])
            yield _keyed(batch, keys, chunks.group[new], _i=pa.array(exits[new]))

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = _Chunks(batch)
            lists = batch.column(batch.schema.get_field_index("_entries"))
            entries = lists.flatten().to_numpy()
            group = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            there = entries + chunks.shift[group] < chunks.offsets[1:][group]
            entries, group = entries[there], group[there]
            yield _keyed(batch, keys, group, _i=pa.array(entries), _to=pa.array(chunks.exits()[entries + chunks.shift[group]]))

    start = packed.where("_chunk = 0").select(*keys, F.lit(0).cast("bigint").alias("_i"))
    pointers = packed.select(*keys, "_first", "_s").mapInArrow(leaving, f"{types}, _i bigint")
    entries = (pointers.unionByName(start).distinct().groupBy(*keys, F.floor(F.col("_i") / chunk).cast("bigint").alias("_chunk"))
               .agg(F.collect_list("_i").alias("_entries")))
    jumps = stage(packed.join(entries, [*keys, "_chunk"]).select(*keys, "_first", "_s", "_entries").mapInArrow(passed, f"{types}, _i bigint, _to bigint"))
    exist = jumps.select(*keys, "_i")
    visited, known = stage(start), 0
    jumps = stage(jumps.join(exist.withColumnRenamed("_i", "_to"), [*keys, "_to"], "left_semi"))
    while True:
        onward = visited.join(jumps, [*keys, "_i"]).select(*keys, F.col("_to").alias("_i"))
        visited = stage(visited.unionByName(onward).distinct())
        number = visited.count()
        if number == known:
            return visited
        known = number
        further = jumps.select(*keys, F.col("_i").alias("_to"), F.col("_to").alias("_end"))
        jumps = stage(jumps.join(further, [*keys, "_to"]).select(*keys, "_i", F.col("_end").alias("_to")))
