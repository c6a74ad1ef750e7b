"""Playability scoring of token sequences, one row in, one row out.

Objects come from one reconstruction per row; every metric is an array
expression over them, so scoring a corpus needs no exchange at all.  The lane
walk is a fold with a fixed-size state.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import sql_text
from lanestride.operators.grammar import KEY, MECH, SOLID, STEP, max_repetition, with_objects

CONTROL_GAP = 8


def diversity(tokens: str) -> Column:
    return F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1))


def duplicate_positions(objects: str, lexicon: Lexicon = DEFAULT) -> Column:
    """Occupied cells minus distinct cells; a solid occupies ``width`` cells."""
    wide = f"CASE WHEN {lexicon.is_in('o.token', 'solids')} THEN greatest(1, o.width) ELSE 1 END"
    cells = f"flatten(transform({objects}, o -> transform(sequence(0, int({wide}) - 1), d -> (o.x_step + d) * 65536 + o.y_lane)))"
    return F.expr(f"element_at(transform(array({cells}), c -> size(c) - size(array_distinct(c))), 1)").cast("bigint")


def max_objects_per_step(objects: str) -> Column:
    """Objects arrive ordered by step, so a step's count is a run length."""
    return max_repetition(f"transform({objects}, o -> o.x_step)")


def control_spam(objects: str, lexicon: Lexicon = DEFAULT, gap: int = CONTROL_GAP) -> Column:
    """Controls nearer than ``gap`` steps to the previous control of their category."""
    parts = []
    for group in ("portals", "gravity", "speed"):
        steps = f"transform(filter({objects}, o -> {lexicon.is_in('o.token', group)}), o -> o.x_step)"
        parts.append(f"element_at(transform(array({steps}), s -> size(filter(transform(s, (x, i) -> x - get(s, i - 1)), "
                     f"d -> d < {gap}))), 1)")
    return F.expr(" + ".join(parts)).cast("bigint")


def next_lane_sql(lane: str, o: str, lexicon: Lexicon) -> str:
    """Lane after meeting object ``o``."""
    return (f"CASE WHEN {lexicon.is_in(f'{o}.token', 'solids')} THEN "
            f"CASE WHEN {o}.y_lane <= {lane} AND {o}.y_lane + 1 >= {lane} THEN greatest({lane}, {o}.y_lane + 1) "
            f"WHEN {o}.y_lane < {lane} THEN greatest(1, {o}.y_lane + 1) ELSE {lane} END "
            f"WHEN {lexicon.is_in(f'{o}.token', 'orbs')} THEN greatest(greatest(1, {lane} - 2), least(least(15, {lane} + 2), {o}.y_lane)) "
            f"WHEN {lexicon.is_in(f'{o}.token', 'pads')} THEN greatest(1, least(15, {o}.y_lane + 1)) ELSE {lane} END")


PATH = "struct<lane:bigint,step:bigint,at:bigint,prev:bigint,gaps:bigint,jumps:bigint,hits:bigint>"


def path_metrics(objects: str, lexicon: Lexicon = DEFAULT, max_gap: int = 6, max_jump: int = 4,
                 obstacle: str = "BLOCK") -> Column:
    """``(gaps, jumps, hits)`` of the lane path, by a fold whose state is seven numbers.

    The path stores one lane per step; another object at the same step replaces
    it by the half-even mean of the stored lane and its own.  ``prev`` is the
    final lane of the step before the current one, so a jump is counted when a
    step closes, and once more at the end.
    """
    nxt = next_lane_sql("a.lane", "o", lexicon)
    new_step = "(a.step IS NOT NULL AND o.x_step <> a.step)"
    closed = f"({new_step} AND a.prev IS NOT NULL AND abs(a.at - a.prev) > {max_jump})"
    fold = (
        "named_struct('lane', bigint(n), 'step', bigint(o.x_step), "
        "'at', CASE WHEN a.step = o.x_step THEN bigint(bround((a.at + n) / 2.0D, 0)) ELSE bigint(n) END, "
        f"'prev', CASE WHEN {new_step} THEN a.at ELSE a.prev END, "
        f"'gaps', a.gaps + CASE WHEN {new_step} AND o.x_step - a.step > {max_gap} THEN 1L ELSE 0L END, "
        f"'jumps', a.jumps + CASE WHEN {closed} THEN 1L ELSE 0L END, "
        f"'hits', a.hits + CASE WHEN o.token = {sql_text(obstacle)} AND o.y_lane > 0 "
        f"AND o.y_lane IN (a.lane, a.lane + 1) THEN 1L ELSE 0L END)")
    start = f"CAST(named_struct('lane', 1, 'step', NULL, 'at', NULL, 'prev', NULL, 'gaps', 0, 'jumps', 0, 'hits', 0) AS {PATH})"
    step = f"element_at(transform(array({nxt}), n -> CAST({fold} AS {PATH})), 1)"
    finish = (f"a -> named_struct('gaps', a.gaps, 'jumps', a.jumps + CASE WHEN a.prev IS NOT NULL "
              f"AND abs(a.at - a.prev) > {max_jump} THEN 1L ELSE 0L END, 'hits', a.hits)")
    return F.expr(f"aggregate({objects}, {start}, (a, o) -> {step}, {finish})")


def lane_path(objects: str, lexicon: Lexicon = DEFAULT) -> Column:
    """The path itself as an array of (step, lane); step 0, lane 1 when there are no objects.

    Lanes are folded per object and the steps are closed afterwards.  The fold
    appends to a short array that moves to a list of arrays when it is full, so
    an object never copies the whole path.
    """
    full = 64
    entry = "struct<step:bigint,lane:bigint,at:bigint>"
    state = f"struct<done:array<array<{entry}>>,now:array<{entry}>>"
    last = "try_element_at(a.now, -1)"
    nxt = next_lane_sql(f"coalesce({last}.lane, 1)", "o", lexicon)
    at = f"CASE WHEN {last}.step = o.x_step THEN bigint(bround(({last}.at + n) / 2.0D, 0)) ELSE bigint(n) END"
    added = f"array(CAST(named_struct('step', o.x_step, 'lane', bigint(n), 'at', {at}) AS {entry}))"
    grown = (f"element_at(transform(array({nxt}), n -> CAST(CASE WHEN size(a.now) < {full} THEN named_struct('done', a.done, 'now', concat(a.now, {added})) "
             f"ELSE named_struct('done', concat(a.done, array(a.now)), 'now', {added}) END AS {state})), 1)")
    start = f"CAST(named_struct('done', array(), 'now', array()) AS {state})"
    folded = f"aggregate({objects}, {start}, (a, o) -> {grown}, a -> flatten(concat(a.done, array(a.now))))"
    ends = "filter(p, (e, i) -> get(p, i + 1) IS NULL OR get(p, i + 1).step <> e.step)"
    return F.expr(f"CASE WHEN size({objects}) = 0 THEN array(named_struct('step', 0L, 'lane', 1L)) ELSE "
                  f"element_at(transform(array({folded}), p -> transform({ends}, e -> named_struct('step', e.step, 'lane', e.at))), 1) END")


def quality_report(sequences: DataFrame, lexicon: Lexicon = DEFAULT, key: str = KEY,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """All quality columns of each sequence; ``keep`` passes other columns through."""
    among = lambda group: F.expr(f"size(filter(_mechanics, t -> {lexicon.is_in('t', group)}))")
    base = (with_objects(sequences, lexicon)
            .withColumn("object_count", F.size("objects").cast("bigint"))
            .withColumn("step_count", F.expr(f"size(filter(kinds, k -> k = {STEP}))").cast("bigint"))
            .withColumn("_mechanics", F.expr(f"filter(tokens, (t, i) -> kinds[i] IN ({SOLID}, {MECH}))"))
            .withColumn("duplicate_positions", duplicate_positions("objects", lexicon))
            .withColumn("max_objects_per_step", max_objects_per_step("objects"))
            .withColumn("control_spam", control_spam("objects", lexicon))
            .withColumn("_path", path_metrics("objects", lexicon))
            .withColumn("diversity", diversity("tokens"))
            .withColumn("_n", F.greatest(F.size("tokens"), F.lit(1))))
    c = F.col
    target = F.greatest(F.lit(8), F.least(F.lit(160), c("step_count")))
    balance = F.lit(1.0) - F.least(F.lit(1.0), F.abs(c("object_count") - target) / target)
    capped = lambda share: F.least(share, F.lit(0.45))
    score = (F.lit(100.0)
             - F.size("errors") * 18.0 - c("duplicate_positions") * 5.0
             - F.greatest(F.lit(0), c("max_objects_per_step") - 3) * 6.0
             - c("control_spam") * 8.0 - c("_path.gaps") * 4.0 - c("_path.jumps") * 7.0 - c("_path.hits") * 9.0
             + balance * 24.0 + capped(c("diversity")) * 30.0 + capped(F.size("_mechanics") / c("_n")) * 18.0
             + capped(c("step_count") / c("_n")) * 10.0
             + F.least(among("orbs"), F.lit(12)) * 0.8 + F.least(among("portals"), F.lit(4)) * 0.8
             - F.when(c("object_count") == 0, 80.0).otherwise(0.0)
             - F.when(c("step_count") < 12, 30.0).otherwise(0.0))
    return base.select(
        key, *keep, F.round(F.greatest(F.lit(0.0), score), 6).alias("score"),
        ((F.size("errors") == 0) & (c("object_count") > 0)).alias("valid"), F.slice("errors", 1, 20).alias("errors"),
        "object_count", "step_count", "duplicate_positions", "max_objects_per_step", "control_spam",
        c("_path.gaps").alias("path_gaps"), c("_path.jumps").alias("path_jumps"),
        c("_path.hits").alias("path_obstructions"), F.round("diversity", 6).alias("diversity"),
        max_repetition("tokens").alias("max_repetition"))


def collapse_flag(reports: DataFrame, min_diversity: float = 0.18, max_run: int = 16, min_score: float = 80.0,
                  max_obstructions: int = 0, max_spam: int = 2) -> DataFrame:
    c = F.col
    return reports.withColumn("collapsed", (c("diversity") < min_diversity) | (c("max_repetition") > max_run)
                              | (c("score") < min_score) | (c("path_obstructions") > max_obstructions)
                              | (c("control_spam") > max_spam))


def rank_candidates(candidates: DataFrame, group: str, index: str) -> DataFrame:
    """Best candidate per group by validity, quality + 0.55 flow, sync, lowest index.

    A mergeable ``max`` over an ordered struct: candidates combine map-side and
    no group is ever sorted or gathered.
    """
    rest = [c for c in candidates.columns if c != group]
    order = F.struct(F.col("valid").cast("int"), F.col("score") + F.col("flow_score_total") * 0.55,
                     F.col("sync_score"), -F.col(index))
    return (candidates.groupBy(group).agg(F.max_by(F.struct(*rest), order).alias("best")).select(group, "best.*"))
