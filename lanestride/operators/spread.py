"""Building blocks that keep one hot key from landing in one task.

A single level, series or code may hold a large share of all rows.  The
operators therefore never window or collect over a raw key.  They use:

* ``attach``        per-key facts joined onto rows, in the one form whose hot
                    partitions the engine splits by itself at run time;
* ``halo``          fixed-width index chunks with a few copied neighbour rows,
                    so ``lag``/``lead`` windows partition by (key, chunk);
* ``ordered_index`` dense row numbers from bucket counts plus in-bucket ranks;
* ``order_statistic`` exact k-th value per key from counts, never a full sort;
* ``islands``       maximal runs of positions closer than a gap, the units in
                    which a greedy rule restarts.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

INDEX_CHUNK = 4096


def attach(rows: DataFrame, facts: DataFrame, key: str | Sequence[str], keep_unmatched: bool = False) -> DataFrame:
    """Join one-row-per-key ``facts`` onto ``rows`` (inner, or left with ``keep_unmatched``).

    A plain equi-join: the engine broadcasts ``facts`` where its measured size
    allows, and otherwise splits the row partitions that a hot key makes large
    (adaptive skew join); each split reads the one fact row again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    carried = [c for c in facts.columns if c not in keys]
    return rows.join(facts, keys, "left" if keep_unmatched else "inner").select(*rows.columns, *carried)


def attach_dense(rows: DataFrame, facts: DataFrame, key: str, count: str, index: str, chunk: int = INDEX_CHUNK) -> DataFrame:
    """Join per-key ``facts`` onto rows that carry a dense 0-based ``index``.

    A key with ``count`` rows has exactly ceil(count / chunk) index chunks, so the
    facts are repeated once per chunk and the join runs on (key, chunk): a hot
    key is cut evenly and nothing needs to be broadcast.
    """
    last = F.floor((F.col(count) - 1) / chunk).cast("bigint")
    per_chunk = facts.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return (rows.withColumn("_at", F.floor(F.col(index) / chunk).cast("bigint")).join(per_chunk, [key, "_at"]).drop("_at"))


def halo(rows: DataFrame, index: str, before: int, after: int, chunk: int = INDEX_CHUNK,
         only: Column | None = None) -> DataFrame:
    """Add ``_chunk``/``_own`` so windows by (key, ``_chunk``) see their neighbours.

    A row goes to its own chunk and, when it sits within ``before`` positions of
    a chunk's end or ``after`` of its start, to the adjoining chunk as a copy
    with ``_own`` false.  ``before`` and ``after`` must be below ``chunk``.
    """
    if max(before, after) >= chunk:
        raise ValueError("halo must be narrower than a chunk")
    place = F.col(index)
    own = F.floor(place / chunk).cast("bigint")
    inside = place - own * chunk
    wanted = F.lit(True) if only is None else only
    targets = F.array_compact(F.array(
        own,
        F.when(wanted & (inside >= chunk - before), own + 1),
        F.when(wanted & (inside < after), own - 1),
    ))
    return (rows.withColumn("_chunk", F.explode(targets))
                .withColumn("_own", F.col("_chunk") == own))


GROUP_BUCKETS = 4096


def ordered_index(rows: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column | str],
                  name: str, group: Column | None = None, weight: str | None = None) -> DataFrame:
    """Dense 0-based position of each row within ``keys``, ordered by (bucket, order).

    With ``weight``, the sum of that column over the rows before, instead of their number.

    ``bucket`` must not decrease in the wanted order; unless it is an integer,
    ``group`` (over ``_bucket``) must name a coarser value that does not either.
    Rows are ranked inside their bucket, bucket totals are summed up inside
    groups of ``GROUP_BUCKETS`` buckets, and only the groups' totals meet in one
    window per key: a few thousand rows for a billion buckets' worth of rows.
    """
    keys = list(keys)
    tagged = rows.withColumn("_bucket", bucket)
    totals = (tagged.groupBy(*keys, "_bucket").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_rows"))
              .withColumn("_group", F.floor(F.col("_bucket") / GROUP_BUCKETS) if group is None else group))
    before = lambda window: window.rowsBetween(W.unboundedPreceding, -1)
    groups = totals.groupBy(*keys, "_group").agg(F.sum("_rows").alias("_all"))
    groups = groups.select(*keys, "_group", F.coalesce(F.sum("_all").over(before(W.partitionBy(*keys).orderBy("_group"))), F.lit(0)).alias("_far"))
    inside_group = before(W.partitionBy(*keys, "_group").orderBy("_bucket"))
    near = totals.select(*keys, "_bucket", "_group", F.coalesce(F.sum("_rows").over(inside_group), F.lit(0)).alias("_near"))
    offsets = near.join(groups, [*keys, "_group"]).select(*keys, "_bucket", (F.col("_near") + F.col("_far")).alias("_offset"))
    placed = tagged.join(offsets, [*keys, "_bucket"])
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order)
    local = F.coalesce(F.sum(weight).over(before(inside)), F.lit(0)) if weight else F.row_number().over(inside) - 1
    return (placed.withColumn(name, local + F.col("_offset"))
                  .drop("_bucket", "_offset"))


NEAR_CELLS, OCTAVE_CELLS, SUB_CELLS = 16384, 64, 4096


def magnitude_cell(value: Column, grain: float) -> Column:
    """Non-decreasing cell of a value: steps of ``grain`` near zero, 64 to an octave beyond; at most about 160,000 cells."""
    scaled = value.cast("double") / grain
    far = F.lit(NEAR_CELLS) + F.floor(F.log2(F.greatest(F.abs(scaled), F.lit(float(NEAR_CELLS))) / NEAR_CELLS) * OCTAVE_CELLS)
    return (F.when(F.abs(scaled) < NEAR_CELLS, F.floor(scaled)).when(scaled > 0, far).otherwise(-far - 1)).cast("int")


def order_statistic(rows: DataFrame, keys: Sequence[str], value: str, rank_of: Column, out: str,
                    extra: dict[str, Column] | None = None, grain: float = 1.0, place: str | None = None) -> DataFrame:
    """The exact value at 0-based rank ``rank_of`` (an expression over ``n``) per key.

    One pass counts distinct values map-side.  Values fall into cells whose
    number is bounded whatever their range; prefix sums over the cells find
    the one that holds the rank, the same over equal slices of that cell's own
    range find the slice, and only the slice's values are ordered.
    ``extra`` maps names to ``min`` aggregates computed in the same pass;
    ``place`` names the 0-based place of the rank among the rows of that value.
    """
    keys = list(keys)
    extra = extra or {}
    names = list(extra)
    counted = (rows.withColumn("_cell", magnitude_cell(F.col(value), grain))
                   .groupBy(*keys, "_cell", F.col(value).alias("_value"))
                   .agg(F.count(F.lit(1)).alias("_c"), *[e.alias(n) for n, e in extra.items()]))

    def holding(parts: DataFrame, place: str, window: W) -> DataFrame:
        upto = window.orderBy(place).rowsBetween(W.unboundedPreceding, W.currentRow)
        found = parts.withColumn("_below", F.sum("_c").over(upto) - F.col("_c") + F.col("_below"))
        return found.where((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_c")))

    whole = W.partitionBy(*keys)
    cells = counted.groupBy(*keys, "_cell").agg(F.sum("_c").alias("_c"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi"), *[F.min(n).alias(n) for n in names])
    ranked = (cells.withColumn("n", F.sum("_c").over(whole)).withColumns({n: F.min(n).over(whole) for n in names})
                   .withColumn("_rank", rank_of).withColumn("_below", F.lit(0).cast("bigint")))
    target = holding(ranked, "_cell", whole).select(*keys, "_cell", "n", "_rank", "_below", "_lo", "_hi", *names)
    share = (F.col("_value").cast("double") - F.col("_lo").cast("double")) / F.greatest(F.col("_hi").cast("double") - F.col("_lo").cast("double"), F.lit(1e-300))
    inside = counted.drop(*names).join(target, [*keys, "_cell"]).withColumn("_sub", F.floor(share * SUB_CELLS).cast("int"))
    told = ["n", "_rank", "_below", *names]
    subs = inside.groupBy(*keys, "_sub").agg(F.sum("_c").alias("_c"), *[F.min(c).alias(c) for c in told])
    slice_ = holding(subs, "_sub", whole).select(*keys, "_sub", *told)
    last = inside.drop(*told).join(slice_, [*keys, "_sub"])
    among = [(F.col("_rank") - F.col("_below")).cast("bigint").alias(place)] if place else []
    return holding(last, "_value", whole).select(*keys, "n", F.col("_value").alias(out), *names, *among)


def islands(rows: DataFrame, keys: Sequence[str], place: str, gap: float, name: str = "_island") -> DataFrame:
    """Label each row with the first (``name``) and last (``name``_end) position of its island.

    An island is a maximal run in which neighbours are less than ``gap`` apart.
    Rows in one grid cell of width ``gap`` are always closer than that, so a cell
    belongs to one island and only the step between neighbouring cells decides.
    The window runs over cells, whose number is span/gap however many rows they hold.
    """
    keys = list(keys)
    cell = F.floor(F.col(place) / gap).cast("bigint")
    tagged = rows.withColumn("_cell", cell)
    spans = tagged.groupBy(*keys, "_cell").agg(F.min(place).alias("_lo"), F.max(place).alias("_hi"))
    chain = W.partitionBy(*keys).orderBy("_cell")
    starts = (spans.withColumn("_first", (F.lag("_hi").over(chain).isNull())
                               | (F.col("_lo") - F.lag("_hi").over(chain) >= gap))
                   .withColumn(name, F.last(F.when(F.col("_first"), F.col("_lo")), ignorenulls=True)
                               .over(chain.rowsBetween(W.unboundedPreceding, W.currentRow))))
    ends = starts.withColumn(f"{name}_end", F.max("_hi").over(W.partitionBy(*keys, name)))
    return tagged.join(ends.select(*keys, "_cell", name, f"{name}_end"), [*keys, "_cell"]).drop("_cell")


def neighbours(points: DataFrame, probes: DataFrame, keys: Sequence[str], place: str, width: float,
               value: str | None = None) -> DataFrame:
    """Nearest point at or before and at or after each distinct probe position.

    Both inputs hold ``keys`` and ``place``; ``points`` may carry ``value``.
    Adds ``prev_at``/``next_at`` (and ``prev_value``/``next_value``).  Points and
    probes meet inside grid cells of ``width``; the last point before a cell and
    the first after it are carried over the cells of its group of
    ``GROUP_BUCKETS``, and from group to group.
    """
    keys = list(keys)
    carried = F.struct(F.col(place).alias("at"), (F.col(value) if value else F.lit(None).cast("double")).alias("value"))
    cell = F.floor(F.col(place) / width).cast("bigint").alias("_cell")
    pts = points.groupBy(*keys, place).agg(*([F.min(value).alias(value)] if value else [F.count(F.lit(1)).alias("_n")]))
    both = pts.select(*keys, place, cell, carried.alias("_p"), F.lit(0).alias("_probe")).unionByName(
        probes.select(*keys, place).distinct().select(
            *keys, place, cell, F.lit(None).cast(pts.select(carried.alias("c")).schema[0].dataType).alias("_p"),
            F.lit(1).alias("_probe")))
    cells = both.groupBy(*keys, "_cell").agg(F.min("_p").alias("_lo"), F.max("_p").alias("_hi"))
    # Both directions are running frames; one that reaches to the end would be quadratic.
    cells = cells.withColumn("_group", F.floor(F.col("_cell") / GROUP_BUCKETS).cast("bigint"))
    groups = cells.groupBy(*keys, "_group").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))

    def carried_over(table: DataFrame, within: Sequence[str], order: str, before: str, after: str) -> DataFrame:
        earlier = lambda by: W.partitionBy(*within).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        return table.withColumn(before, F.last("_hi", True).over(earlier(F.asc(order)))).withColumn(after, F.last("_lo", True).over(earlier(F.desc(order))))

    near = carried_over(cells, [*keys, "_group"], "_cell", "_before", "_after").select(*keys, "_group", "_cell", "_before", "_after")
    far = carried_over(groups, keys, "_group", "_long_before", "_long_after").select(*keys, "_group", "_long_before", "_long_after")
    edges = near.join(far, [*keys, "_group"]).select(*keys, "_cell", F.coalesce("_before", "_long_before").alias("_before"), F.coalesce("_after", "_long_after").alias("_after"))
    inside = W.partitionBy(*keys, "_cell")
    running = lambda order: inside.orderBy(order, "_probe").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = (both.withColumn("_l", F.last("_p", True).over(running(F.asc(place))))
                 .withColumn("_r", F.last("_p", True).over(running(F.desc(place))))
                 .where("_probe = 1").join(edges, [*keys, "_cell"])
                 .withColumn("_l", F.coalesce("_l", "_before")).withColumn("_r", F.coalesce("_r", "_after")))
    out = [F.col("_l.at").alias("prev_at"), F.col("_r.at").alias("next_at")]
    if value:
        out += [F.col("_l.value").alias("prev_value"), F.col("_r.value").alias("next_value")]
    return found.select(*keys, place, *out)


def count_up(rows: DataFrame, last: Column, name: str, block: int = 4096) -> DataFrame:
    """One output row per integer 0..``last``, generated in blocks so no row builds a long array."""
    blocks = rows.withColumn("_last", last.cast("bigint")).where(F.col("_last") >= 0).withColumn(
        "_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / block).cast("bigint"))))
    low = F.col("_b") * block
    return (blocks.withColumn(name, F.explode(F.sequence(low, F.least(F.col("_last"), low + block - 1))))
                  .drop("_b", "_last"))
