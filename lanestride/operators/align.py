"""Alignment of object sequences with a series: step profiles, sync and flow scores."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from lanestride.dims import (DEFAULT, DIFFICULTY_DENSITY, STYLE_BIAS, STYLE_DENSITY, STYLE_RATE, Lexicon,
                             relation, style_values)
from lanestride.functions.columns import half_even, sql_text, unnest
from lanestride.operators.grammar import KEY, with_objects
from lanestride.operators.series import S, nearest_value
from lanestride.operators.spread import count_up, halo, neighbours, ordered_index


def _lookup(table: dict[str, float]) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(float(v)))])


def _style_sum(table: dict[str, float], styles: Column) -> Column:
    """Sum over the styles that are not blank; none at all counts as ``flow``."""
    lookup = _lookup(table)
    given = F.filter(F.coalesce(styles, F.array().cast("array<string>")), lambda s: F.trim(s) != "")
    given = F.when(F.size(given) > 0, given).otherwise(F.array(F.lit("flow")))
    return F.aggregate(given, F.lit(0.0), lambda a, s: a + F.coalesce(F.try_element_at(lookup, F.lower(F.trim(s))), F.lit(0.0)))


def given_styles(styles: Column) -> Column:
    """The styles that are not blank, trimmed; ``Flow`` alone if there is none."""
    named = F.filter(F.transform(F.coalesce(styles, F.array().cast("array<string>")), lambda s: F.trim(s)), lambda s: s != "")
    return F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("Flow")))


def style_bias(styles: Column) -> Column:
    """Token multipliers of a list of styles; where several name a token the later one counts."""
    pairs = lambda table: F.create_map(*[x for t, v in table.items() for x in (F.lit(t), F.lit(float(v)))])
    none = F.expr("CAST(map() AS map<string, double>)")
    own = lambda style: F.coalesce(F.try_element_at(F.create_map(*[x for name, table in STYLE_BIAS.items() for x in (F.lit(name), pairs(table))]), F.lower(style)), none)
    return F.aggregate(styles, none, lambda bias, style: F.map_concat(F.map_filter(bias, lambda k, v: ~F.map_contains_key(own(style), k)), own(style)))


def prefix_tokens(difficulty: Column, lexicon: Lexicon = DEFAULT) -> Column:
    """The tokens that a conditioned sequence begins with; an unknown difficulty counts as hard."""
    named = F.concat(F.lit("DIFF_"), F.upper(F.trim(difficulty)))
    known = F.lower(F.trim(difficulty)).isin(list(DIFFICULTY_DENSITY)) & named.isin(list(lexicon.difficulties))
    return F.array(F.lit("START"), F.when(known, named).otherwise(F.lit("DIFF_HARD")), F.lit("ALIGN_UNKNOWN"))


def step_profile(reports: DataFrame, max_tokens: int = 360, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Per series: step length, step count, density, token targets, prefix tokens and token bias.

    ``reports`` holds ``series, duration, bpm, difficulty, styles`` (array).
    """
    c = F.col
    density = F.coalesce(F.try_element_at(_lookup(DIFFICULTY_DENSITY), F.lower(F.trim("difficulty"))),
                         F.lit(DIFFICULTY_DENSITY["hard"])) + _style_sum(STYLE_DENSITY, c("styles"))
    rows = (reports.withColumn("step_seconds", F.greatest(F.lit(0.08), F.lit(60.0) / F.greatest(c("bpm"), F.lit(1)) / 2.0))
            .withColumn("_density", density)
            .withColumn("steps", F.greatest(F.lit(24).cast("bigint"), F.floor(c("duration") / c("step_seconds")).cast("bigint")))
            .withColumn("target_tokens", F.greatest(F.lit(90).cast("bigint"), F.least(
                F.lit(max_tokens).cast("bigint"), F.floor(c("steps") * (F.lit(1.65) + c("_density") * 0.45)).cast("bigint")))))
    return rows.select(S, "duration", "bpm", "styles", "step_seconds", "steps", "target_tokens",
                       F.greatest(F.lit(36).cast("bigint"), F.least(c("target_tokens") - 8,
                                  F.floor(c("target_tokens") * 0.38).cast("bigint"))).alias("min_tokens"),
                       F.greatest(F.lit(0.35), F.least(F.lit(1.75), c("_density"))).alias("density"),
                       prefix_tokens(c("difficulty"), lexicon).alias("prefix"), style_bias(given_styles(c("styles"))).alias("bias"))


def steps_of(times: DataFrame, profile: DataFrame) -> DataFrame:
    """Distinct grid steps of event times."""
    joined = times.select(S, "t").join(profile.select(S, "step_seconds"), S)
    return joined.select(S, F.greatest(F.lit(0).cast("bigint"), half_even(F.col("t") / F.col("step_seconds"))).alias("step")).distinct()


def energy_by_step(energy: DataFrame, profile: DataFrame, beats: DataFrame, onsets: DataFrame) -> DataFrame:
    """Energy at every step from 0 to one past the last relevant step."""
    far = beats.unionByName(onsets).groupBy(S).agg(F.max("step").alias("_far"))
    grid = count_up(profile.select(S, "steps", "step_seconds").join(far, S, "left"),
                    F.greatest(F.col("steps"), F.coalesce("_far", F.lit(0))) + 1, "step")
    probes = grid.select(S, "step", (F.col("step") * F.col("step_seconds")).alias("t"))
    found = nearest_value(energy.select(S, "t", "value"), probes, [S], "t", "value", 64.0)
    return probes.join(found, [S, "t"]).select(S, "step", F.col("value").alias("energy"))


def bias_table(styles: DataFrame, keys: list[str]) -> DataFrame:
    """Token multiplier per key; of several styles the later (``ordinal``) wins.

    A key's rows become one: the last ordinal of each style.  Tokens are told
    from that row, so nothing is grouped by token.  A style without an ordinal does not count.
    """
    names = list(STYLE_BIAS)
    last = styles.groupBy(*keys).agg(*[F.max(F.when(F.lower("style") == n, F.col("ordinal"))).alias(f"_s{i}") for i, n in enumerate(names)])
    offered: dict[str, list[Column]] = {}
    for i, n in enumerate(names):
        for token, multiplier in STYLE_BIAS[n].items():
            offered.setdefault(token, []).append(F.when(F.col(f"_s{i}").isNotNull(), F.struct(F.col(f"_s{i}").alias("at"), F.lit(float(multiplier)).alias("multiplier"))))
    told = F.array(*[F.struct(F.lit(t).alias("token"), F.array_max(F.array(*o))["multiplier"].alias("multiplier")) for t, o in offered.items()])
    return last.select(*keys, F.explode(told).alias("_t")).select(*keys, "_t.token", "_t.multiplier").where("multiplier IS NOT NULL")


def grid_facts(steps: DataFrame) -> DataFrame:
    """Smallest step and grid interval (half-even mean positive gap, 2 if none, at least 1).

    The mean gap of distinct sorted steps is (max - min) / (n - 1): no sort is needed.
    """
    n = F.count(F.lit(1))
    return (steps.select(S, "step").distinct().groupBy(S).agg(
        n.alias("n"), F.min("step").alias("first"),
        F.when(n > 1, F.greatest(F.lit(1).cast("bigint"), half_even((F.max("step") - F.min("step")) / (n - 1))))
         .otherwise(F.lit(2).cast("bigint")).alias("interval")))


def expand_grid(steps: DataFrame, limits: DataFrame) -> DataFrame:
    """Given steps up to ``limit`` plus the regular grid from the first one, per series."""
    facts = grid_facts(steps)
    kept = steps.select(S, "step").join(limits.select(S, "limit"), S).where("step >= 0 AND step <= limit").select(S, "step")
    based = facts.join(limits.select(S, "limit"), S)
    grid = count_up(based, F.floor((F.col("limit") - F.col("first")) / F.col("interval")), "_k").select(
        S, (F.col("first") + F.col("_k") * F.col("interval")).alias("step"))
    return kept.unionByName(grid).distinct()


def sync_counts(sequences: DataFrame, beats: DataFrame, onsets: DataFrame, lexicon: Lexicon = DEFAULT, key: str = KEY,
                width: float = 512.0) -> DataFrame:
    """Beat/onset alignment of each sequence with its series.

    Distances depend on (series, step) only, so they are looked up once per
    distinct pair and joined back; the regular part of the beat set is
    arithmetic.  Objects of support terrain do not count.
    """
    c = F.col
    floor = f"{lexicon.is_in('o.token', 'solids')} AND o.y_lane <= 0"
    counted = (with_objects(sequences, lexicon)
               .select(key, S, F.expr(f"filter(objects, o -> NOT ({floor}))").alias("_o"),
                       F.expr(f"size(filter(tokens, t -> t = {sql_text(lexicon.step)}))").alias("limit")))
    per_step = (unnest(counted, key, S, "limit", o=c("_o"))
                       .groupBy(key, S, "limit", c("o.x_step").alias("step")).agg(F.count(F.lit(1)).alias("_n")))
    probes = per_step.select(S, "step").distinct()
    beat_near = neighbours(beats, probes, [S], "step", width).select(S, "step", c("prev_at").alias("_bp"), c("next_at").alias("_bn"))
    onset_near = neighbours(onsets, probes, [S], "step", width).select(S, "step", c("prev_at").alias("_op"), c("next_at").alias("_on"))
    near = beat_near.join(onset_near, [S, "step"]).join(grid_facts(beats).drop("n"), S, "left")
    joined = per_step.join(near, [S, "step"], "left")
    far = F.lit(999).cast("bigint")
    ahead = c("step") - c("first")
    below = c("first") + F.floor(F.greatest(ahead, F.lit(0)) / c("interval")) * c("interval")
    above = F.when(ahead >= 0, below + c("interval")).otherwise(c("first"))
    within = lambda at: F.when(at <= c("limit"), F.abs(c("step") - at))
    beat = F.coalesce(F.least(within(c("_bp")), within(c("_bn")), within(below), within(above)), far)
    onset = F.coalesce(F.least(c("step") - c("_op"), c("_on") - c("step")), far)
    totals = (joined.withColumn("_b", beat).withColumn("_f", onset).groupBy(key).agg(
        F.sum("_n").alias("scored_objects"),
        F.sum(F.when(c("_b") == 0, c("_n")).otherwise(0)).alias("beat_aligned_objects"),
        F.sum(F.when(c("_f") == 0, c("_n")).otherwise(0)).alias("onset_aligned_objects"),
        F.sum(F.when(F.least(c("_b"), c("_f")) <= 1, c("_n")).otherwise(0)).alias("synced_objects")))
    names = ["scored_objects", "beat_aligned_objects", "onset_aligned_objects", "synced_objects"]
    return (sequences.select(key).join(totals, key, "left").fillna(0, names)
            .withColumn("unsynced_objects", c("scored_objects") - c("synced_objects"))
            .withColumn("sync_score", F.round(F.lit(100.0) * c("synced_objects") / F.greatest(c("scored_objects"), F.lit(1)), 6)))


def flow_lane_sql(lane: str, o: str, lexicon: Lexicon) -> str:
    """The second lane rule: floor solids ignored, hazards push down two lanes."""
    t = f"{o}.token"
    return (f"CASE WHEN {lexicon.is_in(t, 'solids')} THEN CASE WHEN {o}.y_lane <= 0 THEN {lane} "
            f"WHEN {o}.y_lane <= {lane} AND {o}.y_lane + 1 >= {lane} THEN greatest({lane}, {o}.y_lane + 1) "
            f"WHEN {o}.y_lane < {lane} THEN greatest(1, {o}.y_lane + 1) ELSE {lane} END "
            f"WHEN {lexicon.is_in(t, 'orbs')} THEN greatest(greatest(1, {lane} - 2), least(least(15, {lane} + 2), {o}.y_lane)) "
            f"WHEN {lexicon.is_in(t, 'pads')} THEN greatest(1, least(15, {o}.y_lane + 1)) "
            f"WHEN {lexicon.is_in(t, 'control')} THEN {lane} "
            f"WHEN {lexicon.is_in(t, 'hazards')} THEN greatest(1, least(15, {lane} - 2)) ELSE {lane} END")


def max_lane_jump(objects: str, lexicon: Lexicon = DEFAULT) -> Column:
    """Largest change between the lanes after neighbouring objects; state of three numbers."""
    state = "struct<lane:bigint,best:bigint,any:boolean>"
    floor = f"{lexicon.is_in('o.token', 'solids')} AND o.y_lane <= 0"
    step = (f"element_at(transform(array({flow_lane_sql('a.lane', 'o', lexicon)}), n -> CAST(named_struct('lane', bigint(n), "
            f"'best', CASE WHEN a.any THEN greatest(a.best, abs(n - a.lane)) ELSE a.best END, 'any', true) AS {state})), 1)")
    return F.expr(f"aggregate(filter({objects}, o -> NOT ({floor})), CAST(named_struct('lane', 1, 'best', 0, 'any', false) AS {state}), "
                  f"(a, o) -> {step}, a -> a.best)")


def flow_report(sequences: DataFrame, quality: DataFrame, sync: DataFrame, lexicon: Lexicon = DEFAULT, key: str = KEY) -> DataFrame:
    """Flow and combined scores from a quality report, sync counts and the flow lane walk."""
    c = F.col
    jumps = with_objects(sequences, lexicon).select(key, max_lane_jump("objects", lexicon).alias("max_lane_jump"))
    rows = quality.join(sync, key).join(jumps, key)
    flow = F.greatest(F.lit(0.0), F.least(F.lit(100.0),
        F.lit(100.0) - F.greatest(F.lit(0), c("max_lane_jump") - 2) * 10.0 - c("path_obstructions") * 18.0
        - c("duplicate_positions") * 8.0 - F.greatest(F.lit(0), c("max_objects_per_step") - 2) * 10.0
        - c("control_spam") * 10.0 - c("path_jumps") * 8.0))
    some = c("object_count") > 0
    rows = (rows.withColumn("flow_score", F.when(some, flow).otherwise(F.lit(0.0)))
                .withColumn("sync_score", F.when(some, c("sync_score")).otherwise(F.lit(0.0)))
                .withColumn("max_lane_jump", F.when(some, c("max_lane_jump")).otherwise(F.lit(0))))
    return rows.withColumn("flow_score_total", F.round(c("sync_score") * 0.58 + c("flow_score") * 0.42, 6))


# -- choosing event steps -----------------------------------------------------
def target_object_count(profile: DataFrame, steps: Column | None = None, prefix: int = 3) -> DataFrame:
    """Objects to place per series: a clamped rate of the steps within the token budget."""
    c = F.col
    n = c("steps") if steps is None else steps
    rate = F.greatest(F.lit(0.30), F.least(F.lit(0.68), F.lit(0.30) + c("density") * 0.18 + _style_sum(STYLE_RATE, c("styles"))))
    budget = F.greatest(F.lit(1).cast("bigint"), F.floor((c("target_tokens") - prefix - n - 1) / 2).cast("bigint"))
    wanted = F.greatest(F.lit(6).cast("bigint"), half_even(n * rate))
    return profile.select(S, n.alias("steps"), F.greatest(F.lit(1).cast("bigint"), F.least(wanted, budget)).alias("object_count"))


def planned_steps(profile: DataFrame, energies: DataFrame, cap: int = 620) -> DataFrame:
    """Steps to fill: the series' steps within the token budget and ``cap``."""
    c = F.col
    last = energies.groupBy(S).agg(F.max("step").alias("_last"))
    budget = F.greatest(F.lit(18).cast("bigint"), F.floor(c("target_tokens") * 0.66).cast("bigint"))
    return profile.join(last, S, "left").withColumn("planned", F.greatest(F.lit(18).cast("bigint"), F.least(
        F.coalesce("_last", F.lit(24)), budget, F.lit(cap)))).drop("_last")


def event_step_priority(beats: DataFrame, onsets: DataFrame, energies: DataFrame, plans: DataFrame) -> DataFrame:
    """``(series, step, priority)``: beats 2 + energy, onsets 4 + 1.4 energy, the larger of both.

    Steps lie in [2, steps - 2); a series with none gets every fourth step from 3.
    """
    c = F.col
    limits = plans.select(S, c("planned").alias("limit"))
    wanted = (expand_grid(beats, limits).withColumn("_base", F.lit(2.0)).withColumn("_gain", F.lit(1.0))
              .unionByName(onsets.select(S, "step").withColumn("_base", F.lit(4.0)).withColumn("_gain", F.lit(1.4))))
    inside = wanted.join(limits, S).where("step >= 2 AND step < limit - 2").join(energies, [S, "step"], "left")
    scored = inside.groupBy(S, "step").agg(F.max(c("_base") + c("_gain") * F.coalesce("energy", F.lit(0.35))).alias("priority"))
    bare = limits.join(scored.select(S).distinct(), S, "left_anti")
    every4 = (bare.withColumn("step", F.explode(F.expr("filter(sequence(3L, greatest(3L, limit - 3), 4L), s -> s < limit - 2)")))
                  .join(energies, [S, "step"], "left")
                  .select(S, "step", (F.lit(1.0) + F.coalesce("energy", F.lit(0.35))).alias("priority")))
    return scored.unionByName(every4)


SLOPE_CHUNK = 4096
RANK_CELLS = 64.0


def separated_peaks(ranked: DataFrame, step: str, better: Column, chunk: int = SLOPE_CHUNK) -> DataFrame:
    """The steps that a walk from the best to the worst takes when each one taken blocks the step before and after it.

    ``better`` orders the steps of a series strictly, smaller first.  A step that
    beats both neighbours is taken.  Down a slope from such a peak every second
    step is; so a step is taken when its distance to the peak it descends from
    is even, on each side on which a neighbour beats it.  The distance is that to the last place where a
    slope begins, found inside chunks of steps and carried over the table of
    chunks, forwards and backwards.
    """
    at = F.col(step)
    w = W.partitionBy(S, "_chunk").orderBy(step)
    near = halo(ranked.withColumn("_key", better), step, 1, 1, chunk)
    beaten = lambda side, gap: F.coalesce((side("_step").over(w) == at + gap) & (side("_key").over(w) < F.col("_key")), F.lit(False))
    slopes = (near.withColumn("_step", at).withColumn("_left", beaten(F.lag, -1)).withColumn("_right", beaten(F.lead, 1)).where("_own")
                  .withColumn("_from", F.when(~F.col("_left"), at)).withColumn("_to", F.when(~F.col("_right"), at)))
    chunks = slopes.groupBy(S, "_chunk").agg(F.max("_from").alias("_last"), F.min("_to").alias("_first"))
    before = lambda order: W.partitionBy(S).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.select(S, "_chunk", F.max("_last").over(before(F.asc("_chunk"))).alias("_lo"), F.min("_first").over(before(F.desc("_chunk"))).alias("_hi"))
    running = lambda order: W.partitionBy(S, "_chunk").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (slopes.withColumn("_from", F.max("_from").over(running(F.asc(step)))).withColumn("_to", F.min("_to").over(running(F.desc(step))))
                    .join(carried, [S, "_chunk"]))
    down, up = at - F.coalesce("_from", "_lo"), F.coalesce("_to", "_hi") - at
    return placed.where((down % 2 == 0) & (up % 2 == 0)).select(*ranked.columns)


def spaced_top_k(priorities: DataFrame, energies: DataFrame, plans: DataFrame, counts: DataFrame, seed: int = 7, tie: Column | None = None) -> DataFrame:
    """The steps to use: best priorities at least two apart, then any best free step, up to the count.

    Walking by priority and blocking neighbours couples adjacent steps only, so
    the picks follow from slopes (``separated_peaks``) and no series is walked.
    Picks and free steps are ranked by dense indices, and the count is applied to the
    ranks.  Equal priorities are ordered by ``tie``, a hash of the seed, series
    and step unless given, so the result does not depend on partitioning.
    """
    c = F.col
    tie = F.xxhash64(F.lit(seed), c(S), c("step")) if tie is None else tie
    tied = lambda rows: rows.withColumn("_tie", tie)
    nth = lambda rows, value: ordered_index(rows, [S], F.floor(-c(value) * RANK_CELLS).cast("bigint"), [F.desc(value), "_tie"], "_r")
    limits = counts.select(S, "object_count")
    picks = separated_peaks(tied(priorities), "step", F.struct((-c("priority")).alias("p"), c("_tie")))
    chosen = (nth(picks, "priority").join(limits, S).where(c("_r") < c("object_count")).select(S, "step", F.lit("spaced").alias("stage")))
    had = chosen.groupBy(S).agg(F.count(F.lit(1)).alias("_had"))
    inside = count_up(plans.select(S, "planned"), c("planned") - 5, "_k").select(S, (c("_k") + 2).alias("step"))
    free = (inside.join(chosen.select(S, "step"), [S, "step"], "left_anti").join(energies.select(S, "step", "energy"), [S, "step"], "left")
                  .withColumn("energy", F.coalesce("energy", F.lit(0.35))))
    fill = (nth(tied(free), "energy").join(limits, S).join(had, S, "left")
            .where(c("_r") < c("object_count") - F.coalesce("_had", F.lit(0))).select(S, "step", F.lit("fill").alias("stage")))
    return chosen.unionByName(fill)
