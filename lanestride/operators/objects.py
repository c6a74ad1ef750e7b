"""Placed objects: class lookup, origins, grid quantisation, run merging.

Input rows are ``(level_id, seq, object_id, x, y)``; ``seq`` is the source order
inside a level and decides every keep-first rule.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import half_even, sql_in, sql_text
from lanestride.operators.spread import INDEX_CHUNK, attach, halo, order_statistic

LEVEL = "level_id"


def map_tokens(objects: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Keep objects whose raw id has a token.  The map is a fixed literal table."""
    return objects.join(F.broadcast(lexicon.object_map(objects.sparkSession)), "object_id")


def classify_objects(objects: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Add ``token`` (NULL if unmapped) and ``object_class`` mapped/ignored/unknown."""
    mapping = F.broadcast(lexicon.object_map(objects.sparkSession))
    return objects.join(mapping, "object_id", "left").withColumn(
        "object_class",
        F.when(F.col("token").isNotNull(), "mapped")
         .when(F.expr(sql_in("object_id", lexicon.ignored_ids)), "ignored")
         .otherwise("unknown"))


def nearest_rank(rows: DataFrame, keys: list[str], value: str, fraction: float, out: str, **kw) -> DataFrame:
    """Value at index ``round_half_even((n - 1) * fraction)`` of the sorted values."""
    fraction = max(0.0, min(1.0, fraction))
    return order_statistic(rows, keys, value, half_even((F.col("n") - 1) * F.lit(fraction)), out, **kw)


def origins(mapped: DataFrame, fraction: float = 0.05) -> DataFrame:
    """Per level: object count ``n``, ``x_origin`` (minimum) and ``y_origin`` (nearest rank)."""
    return nearest_rank(mapped, [LEVEL], "y", fraction, "y_origin", extra={"x_origin": F.min("x")})


def quantize_step(value: Column, origin: Column, resolution: float) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), half_even((value - origin) / F.lit(float(resolution))))


def quantize_lane(value: Column, origin: Column, resolution: float, lanes: int) -> Column:
    lane = half_even((value - origin) / F.lit(float(resolution)))
    return F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(lanes - 1).cast("bigint"), lane))


def quantize(mapped: DataFrame, facts: DataFrame | None = None, resolution: float = 30.0, lanes: int = 16,
             fraction: float = 0.05) -> DataFrame:
    """Add ``x_step`` and ``y_lane``; both axes use the same resolution."""
    facts = origins(mapped, fraction) if facts is None else facts
    placed = attach(mapped, facts, LEVEL)
    return (placed.withColumn("x_step", quantize_step(F.col("x"), F.col("x_origin"), resolution))
                  .withColumn("y_lane", quantize_lane(F.col("y"), F.col("y_origin"), resolution, lanes))
                  .drop("n", "x_origin", "y_origin"))


def first_per_cell(quantized: DataFrame) -> DataFrame:
    """One row per (level, token, step, lane): the first input object of that cell."""
    keep = [F.min_by(c, "seq").alias(c) for c in ("object_id", "x", "y")]
    return quantized.groupBy(LEVEL, "token", "y_lane", "x_step").agg(F.min("seq").alias("seq"), *keep)


def merge_runs(quantized: DataFrame, lexicon: Lexicon = DEFAULT, chunk_steps: int = INDEX_CHUNK) -> DataFrame:
    """Gameplay rows: other tokens unique per cell, solids merged into runs.

    A run is a maximal stretch of consecutive steps of one (token, lane).  It
    keeps the first object at its first step and a width clamped to
    ``max_width``; what lies beyond is dropped, so a look-ahead of
    ``max_width - 1`` steps decides the width exactly and runs are found in
    step chunks with that halo instead of windows over a whole level.
    """
    reach = lexicon.max_width - 1
    solid = F.expr(lexicon.is_in("token", "solids"))
    cells = halo(first_per_cell(quantized), "x_step", 1, reach, chunk_steps, only=solid)
    chunk = [LEVEL, "token", "y_lane", "_chunk"]
    ranked = cells.withColumn(
        "_run", F.when(solid, F.col("x_step") - F.row_number().over(W.partitionBy(*chunk).orderBy("x_step")))
                 .otherwise(F.col("x_step")))
    first = lambda c: F.min_by(c, "x_step").alias(c)
    runs = ranked.groupBy(*chunk, "_run").agg(
        F.min("x_step").alias("x_step"), F.count(F.lit(1)).alias("_len"),
        first("_own"), first("object_id"), first("x"), first("y"))
    return runs.where("_own").select(
        LEVEL, "object_id", "token", "x", "y", "x_step", "y_lane",
        F.least(F.col("_len"), F.lit(lexicon.max_width)).cast("bigint").alias("width"))


def gameplay_objects(objects: DataFrame, lexicon: Lexicon = DEFAULT, resolution: float = 30.0,
                     fraction: float = 0.05) -> DataFrame:
    """Raw objects to gameplay rows: lookup, origins, grid, merged runs."""
    mapped = map_tokens(objects, lexicon)
    return merge_runs(quantize(mapped, None, resolution, lexicon.lanes, fraction), lexicon)


def rank_sql(lexicon: Lexicon, column: str = "token") -> str:
    """Fixed mechanic order; tokens outside it come last."""
    cases = " ".join(f"WHEN {sql_text(t)} THEN {i}" for i, t in enumerate(lexicon.mechanics))
    return f"CASE {column} {cases} ELSE {len(lexicon.mechanics)} END"


def event_order(gameplay: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Add ``rank`` so rows sort by (x_step, rank, y_lane, object_id)."""
    return gameplay.withColumn("rank", F.expr(rank_sql(lexicon)))


def difficulty_token(column: str, lexicon: Lexicon = DEFAULT) -> Column:
    """Label to difficulty token: trim, upper, blanks to ``_``, one trailing ``_DEMON`` removed."""
    plain = F.regexp_replace(F.replace(F.upper(F.trim(F.coalesce(F.col(column), F.lit("NA")))), F.lit(" "), F.lit("_")),
                             "_DEMON$", "")
    token = F.concat(F.lit("DIFF_"), F.when(plain == "", "NA").otherwise(plain))
    return F.when(token.isin(*lexicon.difficulties), token).otherwise(F.lit("DIFF_NA"))


def lane_token(lane: Column, lexicon: Lexicon = DEFAULT) -> Column:
    return F.concat(F.lit("Y"), F.greatest(F.lit(0), F.least(F.lit(lexicon.lanes - 1), lane)).cast("string"))


def width_token(width: Column, lexicon: Lexicon = DEFAULT) -> Column:
    return F.concat(F.lit("WIDTH_"), F.greatest(F.lit(1), F.least(F.lit(lexicon.max_width), width)).cast("string"))


# -- per-level summaries ------------------------------------------------------
def level_extent(objects: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Coordinate extent and raw count per level, zeros for a level without objects.

    Where ``levels`` carry their ``decoded`` text, so do the results: its length and its header, the first section.
    """
    bounds = objects.groupBy(LEVEL).agg(
        F.count(F.lit(1)).alias("object_count_raw"),
        *[F.round(fn(c), 6).alias(f"{c}_{name}") for c in ("x", "y") for name, fn in (("min", F.min), ("max", F.max))])
    if levels is None:
        return bounds
    zero = {c: 0 for c in bounds.columns if c != LEVEL}
    told = []
    if "decoded" in levels.columns:
        told = [F.coalesce(F.length("decoded"), F.lit(0)).cast("bigint").alias("decoded_length"), F.coalesce(F.substring_index("decoded", ";", 1), F.lit("")).alias("header")]
    return levels.select(LEVEL, *told).join(bounds, LEVEL, "left").fillna(zero)


def tokens_to_gameplay(tokens: DataFrame, gameplay: DataFrame) -> DataFrame:
    """Token records beside their gameplay objects, a row for each object; a record without any is one row with ``missing`` true.

    Columns of the gameplay side that the record has too are left to the record.
    """
    side = gameplay.select(LEVEL, *[c for c in gameplay.columns if c not in tokens.columns]).withColumn("_there", F.lit(True))
    return tokens.join(side, LEVEL, "left").withColumn("missing", F.col("_there").isNull()).drop("_there")


def ranked_list(counts: DataFrame, key: str, value: str, count: str, out: str, top: int | None = None) -> DataFrame:
    """Collect (value, count) per key, largest first, ties by value."""
    if top is not None:
        w = W.partitionBy(key).orderBy(F.desc(count), F.asc(value))
        counts = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
    packed = counts.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct((-F.col(count)).alias("neg"), F.col(value).alias("v")))).alias("_l"))
    return packed.select(key, F.expr(
        f"transform(_l, e -> struct(e.v AS {value}, -e.neg AS {count}))").alias(out))


def id_histogram(objects: DataFrame) -> DataFrame:
    """Count per raw id and level as a descending list; the list is as long as the id domain."""
    counts = objects.groupBy(LEVEL, "object_id").agg(F.count(F.lit(1)).alias("count"))
    return ranked_list(counts, LEVEL, "object_id", "count", "object_id_counts")


def object_stats(objects: DataFrame, lexicon: Lexicon = DEFAULT, top: int = 20) -> DataFrame:
    """Raw/mapped/ignored/unknown counts, unknown ratio and the top unknown ids per level.

    Counts are first taken per (level, id) so that class lookup, sums and the
    top list all read one small pre-aggregated table.
    """
    per_id = classify_objects(
        objects.groupBy(LEVEL, "object_id").agg(F.count(F.lit(1)).alias("count")), lexicon)
    pick = lambda name: F.coalesce(F.sum(F.when(F.col("object_class") == name, F.col("count"))), F.lit(0))
    sums = per_id.groupBy(LEVEL).agg(
        F.sum("count").alias("object_count_raw"), pick("mapped").alias("gameplay_source_object_count"),
        pick("ignored").alias("ignored_object_count"), pick("unknown").alias("unknown_object_count"))
    unknown = ranked_list(per_id.where("object_class = 'unknown'"), LEVEL, "object_id", "count",
                          "top_unknown_object_ids", top)
    return sums.join(unknown, LEVEL, "left").withColumn(
        "unknown_object_ratio", F.round(F.col("unknown_object_count") / F.col("object_count_raw"), 6))
