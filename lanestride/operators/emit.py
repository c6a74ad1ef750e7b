"""Gameplay rows to token sequences, acceptance and run totals."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import sql_text, unnest
from lanestride.operators.grammar import with_errors
from lanestride.operators.objects import LEVEL, difficulty_token, event_order, object_stats


@dataclass(frozen=True)
class Limits:
    min_gameplay_objects: int = 20
    min_tokens: int = 50
    max_unknown_ratio: float = 0.995
    max_token_length: int = 12_000


def _event_sql(lexicon: Lexicon) -> str:
    lane = f"concat('Y', greatest(0, least({lexicon.lanes - 1}, e.y_lane)))"
    width = f"concat('WIDTH_', greatest(1, least({lexicon.max_width}, e.width)))"
    return f"CASE WHEN {lexicon.is_in('e.token', 'solids')} THEN array(e.token, {lane}, {width}) ELSE array(e.token, {lane}) END"


def emit_tokens(gameplay: DataFrame, levels: DataFrame, lexicon: Lexicon = DEFAULT,
                limits: Limits = Limits()) -> DataFrame:
    """``(level_id, tokens, emit_error)`` for every row of ``levels``.

    A sequence holds at least one mark per step, so nothing past step
    ``max_token_length`` can be emitted: rows beyond it fold into one over-long
    marker while steps are packed, which bounds a level's window by the cap and
    a step's list by the cells of a step, whatever the level's size.

    Emission stops before a gap that would pass the cap or after the event that
    did; such a sequence has no closing marks and carries ``emit_error``.
    """
    cap = limits.max_token_length
    late = F.col("x_step") > cap
    cells = event_order(gameplay, lexicon).select(
        LEVEL, F.when(late, F.lit(cap + 1)).otherwise(F.col("x_step")).cast("bigint").alias("x_step"), late.alias("_late"),
        F.when(~late, F.struct("rank", "y_lane", "object_id", "token", "width")).alias("_event"))
    pieces = (cells.groupBy(LEVEL, "x_step")
              .agg(F.array_sort(F.collect_list("_event")).alias("_events"), F.max("_late").alias("_late"))
              .select(LEVEL, "x_step", "_late",
                      F.expr(f"flatten(transform(_events, e -> {_event_sql(lexicon)}))").alias("piece")))
    order = W.partitionBy(LEVEL).orderBy("x_step")
    room = f"CAST({cap} - _base - _gap AS INT)"
    # The event that holds token number room+1 is the overflowing one; keep it to its end.
    follows = _in("get(piece, k)", lexicon.lane_tokens + lexicon.width_tokens)
    last = (f"element_at(filter(sequence({room} + 1, {room} + 3), "
            f"k -> get(piece, k) IS NULL OR NOT {follows}), 1)")
    placed = (pieces.withColumn("_gap", F.col("x_step") - F.coalesce(F.lag("x_step").over(order), F.lit(0)))
                    .withColumn("_size", F.size("piece"))
                    .withColumn("_base", F.sum(F.col("_gap") + F.col("_size")).over(
                        order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_gap") - F.col("_size") + 3)
                    .withColumn("_over", (F.col("_base") + F.col("_gap") + F.col("_size") > cap) | F.col("_late"))
                    .where(F.col("_base") <= cap))
    cut = placed.select(LEVEL, "x_step", "_over", F.expr(
        f"CASE WHEN _base + _gap > {cap} OR _late THEN CAST(array() AS array<string>) "
        f"WHEN _size <= {room} THEN concat(array_repeat({sql_text(lexicon.step)}, CAST(_gap AS INT)), piece) "
        f"ELSE concat(array_repeat({sql_text(lexicon.step)}, CAST(_gap AS INT)), "
        f"slice(piece, 1, {last})) END").alias("_part"))
    bodies = cut.groupBy(LEVEL).agg(
        F.array_sort(F.collect_list(F.struct("x_step", "_part"))).alias("_parts"), F.max("_over").alias("_over"))
    body = F.expr("coalesce(flatten(transform(_parts, p -> p._part)), CAST(array() AS array<string>))")
    over = F.coalesce(F.col("_over"), F.lit(False))
    prefix = F.array(F.lit(lexicon.start), difficulty_token("difficulty", lexicon), F.lit(lexicon.align))
    suffix = F.when(over, F.expr("CAST(array() AS array<string>)")).otherwise(
        F.array(F.lit(lexicon.step), F.lit(lexicon.end)))
    return levels.join(bodies, LEVEL, "left").select(
        *levels.columns, F.concat(prefix, body, suffix).alias("tokens"),
        F.when(over, "absurd_token_length").alias("emit_error"))


def _in(column: str, tokens: tuple[str, ...]) -> str:
    return f"{column} IN (" + ", ".join(sql_text(t) for t in tokens) + ")"


def token_rows(sequences: DataFrame, key: str = LEVEL) -> DataFrame:
    """Long form ``(key, pos, token)`` with 0-based positions."""
    return unnest(sequences, key, token=F.col("tokens"))


def gameplay_counts(gameplay: DataFrame) -> DataFrame:
    """Gameplay rows and distinct steps per level, combined per (level, step) first."""
    per_step = gameplay.groupBy(LEVEL, "x_step").agg(F.count(F.lit(1)).alias("_c"))
    return per_step.groupBy(LEVEL).agg(F.sum("_c").alias("object_count_gameplay"),
                                       F.count(F.lit(1)).alias("unique_x_steps"))


def rejection_reason(lexicon: Lexicon = DEFAULT, limits: Limits = Limits()) -> Column:
    """First matching reason over the columns of :func:`stats_records`; NULL when accepted."""
    count = F.size("tokens")
    return (F.when(F.col("object_count_raw") == 0, "decoded_level_object_count_zero")
             .when(F.col("object_count_gameplay") < limits.min_gameplay_objects, "too_few_gameplay_objects")
             .when(count < limits.min_tokens, "too_few_tokens")
             .when(~F.array_contains("tokens", lexicon.start) | ~F.array_contains("tokens", lexicon.end),
                   "missing_start_or_end")
             .when(F.size("errors") > 0, "invalid_token_grammar")
             .when(F.col("unknown_object_ratio") > limits.max_unknown_ratio, "unknown_object_ratio_too_high")
             .when(F.col("emit_error").isNotNull(), F.col("emit_error"))
             .when(count > limits.max_token_length, "absurd_token_length")
             .when(F.col("unique_x_steps") <= 1, "all_objects_one_timestep"))


def stats_records(objects: DataFrame, gameplay: DataFrame, emitted: DataFrame, lexicon: Lexicon = DEFAULT,
                  limits: Limits = Limits(), decode_failures: DataFrame | None = None) -> DataFrame:
    """One row per level with counters, ``accepted`` and ``reason``.

    ``decode_failures`` (level_id, difficulty, source, reason, detail) yield a stats row and nothing else.
    """
    joined = (with_errors(emitted, lexicon).join(object_stats(objects, lexicon), LEVEL, "left")
                     .join(gameplay_counts(gameplay), LEVEL, "left")
                     .fillna(0, ["object_count_raw", "gameplay_source_object_count", "ignored_object_count",
                                 "unknown_object_count", "object_count_gameplay", "unique_x_steps"])
                     .fillna(1.0, ["unknown_object_ratio"])
                     .withColumn("reason", rejection_reason(lexicon, limits)))
    stats = joined.select(
        *[c for c in (LEVEL, "difficulty", "source") if c in emitted.columns],
        F.col("reason").isNull().alias("accepted"), F.coalesce("reason", F.lit("")).alias("reason"),
        "object_count_raw", "object_count_gameplay", "gameplay_source_object_count", "ignored_object_count",
        "unknown_object_count", "unknown_object_ratio", "top_unknown_object_ids",
        F.size("tokens").cast("bigint").alias("token_count"), "unique_x_steps", "tokens")
    if decode_failures is None:
        return stats
    failed = decode_failures.withColumn("accepted", F.lit(False))
    for c in ("object_count_raw", "object_count_gameplay"):
        failed = failed.withColumn(c, F.lit(0).cast("bigint"))
    return stats.unionByName(failed, allowMissingColumns=True)


def accepted_tokens(stats: DataFrame) -> DataFrame:
    return stats.where("accepted")


def run_summary(stats: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """One row of run totals; every divisor is at least one."""
    ok = F.col("accepted")
    share = F.expr(f"size(filter(tokens, t -> t = {sql_text(lexicon.step)}))") / F.greatest(F.size("tokens"), F.lit(1))
    reason = F.when(F.col("reason") == "", "unknown").otherwise(F.col("reason"))
    per_reason = (stats.groupBy(F.when(~ok, reason).alias("reason"))
                       .agg(F.count(F.lit(1)).alias("n"),
                            F.coalesce(F.sum(F.when(ok, F.size("tokens"))), F.lit(0)).alias("tokens"),
                            F.coalesce(F.max(F.when(ok, F.size("tokens"))), F.lit(0)).alias("longest"),
                            F.coalesce(F.sum(F.when(ok, share)), F.lit(0.0)).alias("density"),
                            F.sum("object_count_raw").alias("raw"),
                            F.coalesce(F.sum("unknown_object_count"), F.lit(0)).alias("unknown")))
    accepted = F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0))
    some = F.greatest(accepted, F.lit(1))
    return per_reason.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("levels_seen"), accepted.alias("levels_accepted"),
        (F.coalesce(F.sum("n"), F.lit(0)) - accepted).alias("levels_rejected"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens_total"),
        F.round(F.coalesce(F.sum("tokens"), F.lit(0)) / some, 6).alias("avg_token_length"),
        F.coalesce(F.max("longest"), F.lit(0)).cast("bigint").alias("max_token_length"),
        F.round(F.coalesce(F.sum("density"), F.lit(0.0)) / some, 6).alias("avg_step_density"),
        F.round(F.coalesce(F.sum("unknown"), F.lit(0)) / F.greatest(F.coalesce(F.sum("raw"), F.lit(0)), F.lit(1)), 6)
         .alias("unknown_object_rate"),
        F.map_from_entries(F.array_sort(F.array_compact(F.collect_list(
            F.when(F.col("reason").isNotNull(), F.struct("reason", "n")))))).alias("rejection_reasons"))
