"""Registered queries: n-grams, series features, alignment, layouts and chunks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanestride.dims import DEFAULT as LEX, STYLE_BIAS, STYLE_BONUS, relation, style_values
from lanestride.operators import align as L, analytics as A, grammar as G, layout as P, ngram as N, quality as Q, series as X, vocabulary as V
from lanestride.plans import bindings as B
from lanestride.plans.catalog_tokens import TC, emitted, quality_sql, text
from lanestride.plans.oracle import SOLID, VOCAB, gap_sql, q, sql
from lanestride.session import stage

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, text: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if text is not None:
            SQL[name] = text
        return fn
    return add


r6 = lambda *cs: [F.round(c, 6).alias(c) for c in cs]
more = lambda *names: sql("", *names).rstrip() + ", "

# -- n-grams ------------------------------------------------------------------
IDS = "ids AS (SELECT level_id, source, [CAST(coalesce(nullif(list_position({0}, t), 0), 2) - 1 AS BIGINT) for t in tokens] AS ids FROM dirty)".format(VOCAB)
WIN = IDS + """, win AS (SELECT level_id, p - 1 AS pos, [CASE WHEN p - 4 + j > 0 THEN ids[p - 4 + j] ELSE 0 END for j in [1, 2, 3]] AS context, ids[p] AS target FROM (
   SELECT level_id, ids, CAST(unnest(range(1, len(ids) + 1)) AS BIGINT) AS p FROM ids))"""
encoded = lambda s, d: B.dirty(s, d).select("level_id", V.encode("tokens").alias("ids"))
windows = lambda s, d: N.context_windows(encoded(s, d), 3)
register("context_windows", more("dirty") + WIN + " SELECT level_id, pos, array_to_string(context, ' ') AS context, target FROM win")(
    lambda s, d: windows(s, d).withColumn("context", F.expr("array_join(transform(context, c -> string(c)), ' ')")))
register("context_windows_first", more("dirty") + WIN + " SELECT level_id, pos, array_to_string(context, ' ') AS context, target FROM win ORDER BY level_id, pos LIMIT 2000")(
    lambda s, d: N.context_windows(encoded(s, d), 3, max_examples=2000).withColumn("context", F.expr("array_join(transform(context, c -> string(c)), ' ')")))
register("recent_records", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")(
    lambda s, d: N.recent_records(B.table(s, d, "events").select("event_id", "user_id", "ts"), 200, "ts", "event_id").drop("ts"))
HASH = "CAST((o_orderkey * 7919) % 1000003 AS BIGINT)"
register("train_eval_split", f"SELECT o_orderkey AS level_id, CASE WHEN r <= greatest(1, floor(n * 8e-1)) THEN 'train' ELSE 'eval' END AS split FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {HASH}) AS r, count(*) OVER () AS n FROM orders)")(
    lambda s, d: N.train_eval_split(B.table(s, d, "orders").selectExpr("o_orderkey AS level_id"), score=F.expr("(level_id * 7919) % 1000003")))
NG = WIN + """, ng AS (SELECT o AS "order", context[4 - o:3] AS context, target, count(*) AS count FROM win, (SELECT unnest([0, 1, 2, 3]) AS o) GROUP BY ALL),
 ngp AS (SELECT *, sum(count) OVER (PARTITION BY "order", context) AS context_total FROM ng)"""
register("ngram_counts", more("dirty") + NG + """ SELECT CAST("order" AS INT) AS "order", array_to_string(context, ' ') AS context, target, count, CAST(context_total AS BIGINT) AS context_total FROM ngp""")(
    lambda s, d: N.ngram_counts(windows(s, d), 3).withColumn("context", F.expr("array_join(transform(context, c -> string(c)), ' ')")))
register("ngram_prob", more("dirty") + NG + """ SELECT CAST("order" AS INT) AS "order", array_to_string(context, ' ') AS context, target, round((count + 1) / (context_total + 67), 9) AS probability FROM ngp""")(
    lambda s, d: N.ngram_probabilities(N.ngram_counts(windows(s, d), 3), len(LEX.base_vocabulary)).select(
        "order", F.expr("array_join(transform(context, c -> string(c)), ' ')").alias("context"), "target", F.round("probability", 9).alias("probability")))
TRAIN = NG.replace("FROM win,", "FROM (SELECT * FROM win WHERE level_id % 5 <> 0),")


@register("sequence_loss", more("dirty") + TRAIN + """, ev AS (SELECT row_number() OVER () AS id, context, target FROM win WHERE level_id % 5 = 0),
 tot AS (SELECT DISTINCT "order", context, context_total FROM ngp),
 evx AS (SELECT id, target, o, context[4 - o:3] AS c FROM ev, (SELECT unnest([0, 1, 2, 3]) AS o)),
 pick AS (SELECT id, max(o) AS o FROM evx JOIN tot t ON t."order" = evx.o AND t.context = evx.c GROUP BY 1),
 pr AS (SELECT (coalesce(n.count, 0) + 1) / (t.context_total + 67) AS p FROM pick JOIN evx USING (id, o) JOIN tot t ON t."order" = evx.o AND t.context = evx.c
   LEFT JOIN ng n ON n."order" = evx.o AND n.context = evx.c AND n.target = evx.target)
 SELECT count(*) AS examples, round(avg(-ln(greatest(p, 1e-12))), 6) AS loss, round(exp(avg(-ln(greatest(p, 1e-12)))), 6) AS perplexity FROM pr""")
def sequence_loss(s: SparkSession, d: str) -> DataFrame:
    rows = windows(s, d)
    counts = N.ngram_counts(rows.where("level_id % 5 <> 0"), 3)
    return N.sequence_loss(counts, rows.where("level_id % 5 = 0"), 3, len(LEX.base_vocabulary)).select("examples", *r6("loss", "perplexity"))


register("reweight_topk", more("dirty") + NG + """, w AS (SELECT "order" AS o, context, target, power(greatest((count + 1) / (context_total + 67), 1e-12), 1 / 9e-1) AS w FROM ngp),
 k AS (SELECT *, row_number() OVER (PARTITION BY o, context ORDER BY w DESC, target) AS r FROM w)
 SELECT CAST(o AS INTEGER) AS "order", array_to_string(context, ' ') AS context, target, round(w / sum(w) OVER (PARTITION BY o, context), 6) AS weight FROM k WHERE r <= 5""")(
    lambda s, d: N.reweight(N.ngram_probabilities(N.ngram_counts(windows(s, d), 3), len(LEX.base_vocabulary)), 0.9, 5).select(
        F.col("order").cast("int").alias("order"), F.expr("array_join(transform(context, c -> string(c)), ' ')").alias("context"), "target", *r6("weight")))
register("style_weights", more("dirty") + TC.format("dirty") + f""", bonus(style, token, b) AS (VALUES {style_values(STYLE_BONUS, 'BIGINT')}),
 mechs AS (SELECT unnest([{q(LEX.mechanics)}]) AS token) SELECT token, CAST(1 + least(5, floor(sqrt(coalesce(count, 0)))) + coalesce((SELECT sum(b) FROM bonus WHERE bonus.token = mechs.token AND style IN ('flow', 'technical')), 0) AS BIGINT) AS weight
 FROM mechs LEFT JOIN tc USING (token)""")(
    lambda s, d: N.style_weights(A.token_counts(B.dirty(s, d)), ["Flow", "Technical"]))
register("training_log", SQL["sequence_loss"].replace("SELECT count(*) AS examples, round(avg(-ln(greatest(p, 1e-12))), 6) AS loss, round(exp(avg(-ln(greatest(p, 1e-12)))), 6) AS perplexity FROM pr",
         "SELECT 'assisted' AS mode, CAST(1 AS BIGINT) AS step, CAST(0 AS BIGINT) AS records, count(*) AS examples, CAST(NULL AS DOUBLE) AS train_loss, round(avg(-ln(greatest(p, 1e-12))), 6) AS eval_loss FROM pr"))(
    lambda s, d: N.training_log(sequence_loss(s, d), 1, 0, "assisted"))

# -- series -------------------------------------------------------------------
energy = lambda s, d: X.rms_by_time(B.series_points(s, d), 1.0, 0.1)
smooth = lambda s, d: X.smooth3(X.minmax_normalise(energy(s, d)))
out = lambda df: df.select("series", "idx", *r6("t", "value"))
pts = "SELECT series, idx, round(t, 6) AS t, round(value, 6) AS value FROM "
register("rms_windows", sql(pts + "energy", "energy"))(lambda s, d: out(energy(s, d)))
register("rms_by_index", """WITH n AS (SELECT user_id % 5 AS series, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) - 1 AS idx, value FROM events)
 SELECT series, CAST(floor(idx / 8) AS BIGINT) AS idx, round(floor(idx / 8) * 8 / 8e1, 6) AS t, round(sqrt(avg(value * value)), 6) AS value FROM n GROUP BY series, floor(idx / 8)""")(
    lambda s, d: out(X.rms_by_index(X.ordered_index(B.table(s, d, "events").selectExpr("user_id % 5 AS series", "event_id", "value AS sample"), ["series"],
                                                    F.floor(F.col("event_id") / 4096), ["event_id"], "idx"), F.lit(80.0), 0.1)))
register("minmax_normalise", sql(pts + "norm", "norm"))(lambda s, d: out(X.minmax_normalise(energy(s, d))))
register("smooth3", sql(pts + "smooth", "smooth"))(lambda s, d: out(smooth(s, d)))
register("onsets", sql("SELECT series, idx, round(t, 6) AS t, round(delta, 6) AS delta FROM cand", "cand"))(
    lambda s, d: X.onset_candidates(smooth(s, d)).select("series", "idx", *r6("t", "delta")))
register("min_gap", sql("SELECT series, round(t, 6) AS t FROM onset", "onset"))(
    lambda s, d: X.min_gap(X.onset_candidates(smooth(s, d)), ["series"], "t", 0.16).select("series", *r6("t")))
register("min_gap_dense", "WITH " + gap_sql("(SELECT user_id % 5 AS series, epoch_us(ts) // 1000000 AS t FROM events)", "series", "t", "7200", "kept") + " SELECT series, t FROM kept")(
    lambda s, d: X.min_gap(B.table(s, d, "events").select(F.expr("user_id % 5").alias("series"), F.expr(f"{B._micros()} div 1000000").alias("t")), ["series"], "t", 7200))


def onsets_and_energy(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = stage(smooth(s, d))
    return stage(X.min_gap(X.onset_candidates(e), ["series"], "t", 0.16)), e


register("onset_gaps", sql("SELECT series, round(t, 6) AS t, round(gap, 6) AS gap FROM gaps", "gaps"))(
    lambda s, d: X.gaps(onsets_and_energy(s, d)[0], ["series"], "t", 256.0).select("series", *r6("t", "gap")))
register("tempo", sql("SELECT series, bpm FROM tempo", "tempo"))(lambda s, d: X.tempo(*onsets_and_energy(s, d)))
register("autocorr_lag", sql("SELECT series, lag, round(score, 6) AS score, round(bpm, 6) AS bpm FROM best", "best"))(
    lambda s, d: X.best_lag(smooth(s, d)).select("series", "lag", *r6("score", "bpm")))


def beats(s: SparkSession, d: str) -> DataFrame:
    on, e = onsets_and_energy(s, d)
    return X.beat_grid(X.tempo(on, e), on, X.durations(e))


register("beat_grid", sql("SELECT series, beat, round(t, 6) AS t FROM beat", "beat"))(lambda s, d: beats(s, d).select("series", "beat", *r6("t")))
SEC = """sec AS (SELECT d.series, k AS section, k * w AS start, CASE WHEN k = c - 1 THEN duration ELSE (k + 1) * w END AS fin FROM (SELECT *, greatest(duration / c, 1e-1) AS w FROM (SELECT *, greatest(1, least(12, points)) AS c FROM dur)) d, range(0, 12) r(k) WHERE k < c),
 secm AS (SELECT sec.series, section, start, fin, coalesce(avg(value), 0) AS energy FROM sec LEFT JOIN smooth s ON s.series = sec.series AND s.t >= start AND s.t < fin GROUP BY ALL),
 secl AS (SELECT *, CASE WHEN energy >= 72e-2 THEN 'drop' WHEN energy >= 48e-2 THEN 'build' WHEN energy <= 22e-2 THEN 'quiet' ELSE 'steady' END AS label FROM secm)"""
register("sections", more("smooth", "dur") + SEC + ' SELECT series, section, round(start, 6) AS start, round(fin, 6) AS "end", round(energy, 6) AS energy, label FROM secl')(
    lambda s, d: (lambda e: X.sections(e, X.durations(e)).select("series", "section", *r6("start", "end", "energy"), "label"))(stage(smooth(s, d))))
REPORTED = "'[' || string_agg(label || '@' || CAST(round(start * 1e3, 0) AS BIGINT) || '-' || CAST(round(fin * 1e3, 0) AS BIGINT) || '=' || CAST(round(energy * 1e4, 0) AS BIGINT), ' ' ORDER BY section) || ']'"
register("series_report", more("beat", "smooth") + SEC + f""" SELECT series, round(duration, 3) AS duration, bpm, (SELECT count(*) FROM beat b WHERE b.series = dur.series) AS beats, (SELECT count(*) FROM onset o WHERE o.series = dur.series) AS onsets, points,
  (SELECT {REPORTED} FROM (SELECT section, start, fin, label, round(energy, 4) AS energy FROM secl l WHERE l.series = dur.series)) AS sections FROM dur JOIN tempo USING (series)""")(
    lambda s, d: X.series_report(smooth(s, d)).withColumn("sections", F.expr(
        "concat('[', array_join(transform(sections, e -> concat(e.label, '@', cast(round(e.start * 1e3, 0) as bigint), '-', cast(round(e.`end` * 1e3, 0) as bigint), '=', cast(round(e.energy * 1e4, 0) as bigint))), ' '), ']')")))
register("series_pages", more("beat", "smooth") + """ a AS (SELECT series, 'beats' AS kind, beat AS n, round(t, 3) AS t, NULL AS value FROM beat UNION ALL SELECT series, 'onsets', row_number() OVER (PARTITION BY series ORDER BY t) - 1, round(t, 3), NULL FROM onset
  UNION ALL SELECT series, 'energy', idx, round(t, 3), round(value, 4) FROM smooth) SELECT series, kind, CAST(n // 50 AS BIGINT) AS page, CAST(n % 50 AS BIGINT) AS place, t, value FROM a""")(
    lambda s, d: X.series_analysis(smooth(s, d), page=50)[1].select("series", "kind", "page", F.posexplode("values").alias("place", "v")).select("series", "kind", "page", F.col("place").cast("bigint").alias("place"), "v.t", "v.value"))
PROBES = "probes AS (SELECT DISTINCT user_id % 5 AS series, CAST((user_id * 37) % 800 AS DOUBLE) / 1e1 AS t FROM events)"
probes = lambda s, d: B.table(s, d, "events").selectExpr("user_id % 5 AS series", "CAST((user_id * 37) % 800 AS DOUBLE) / 10.0D AS t").distinct()
register("nearest_value", more("smooth") + PROBES + """ SELECT p.series, round(p.t, 6) AS t, round((SELECT value FROM smooth s WHERE s.series = p.series ORDER BY abs(round(s.t - p.t, 9)), s.t LIMIT 1), 6) AS value FROM probes p""")(
    lambda s, d: X.nearest_value(smooth(s, d).withColumn("t", F.round("t", 1)), probes(s, d).withColumn("t", F.round("t", 1)), ["series"], "t", "value", 6.4).select("series", *r6("t", "value")))
register("nearest_distance", """WITH ev AS (SELECT DISTINCT event_type AS series, epoch_us(ts) // 1000000 AS step FROM events WHERE event_id % 2 = 0), pr AS (SELECT DISTINCT event_type AS series, epoch_us(ts) // 1000000 AS step FROM events WHERE event_id % 2 = 1)
 SELECT pr.series, pr.step, coalesce((SELECT min(abs(ev.step - pr.step)) FROM ev WHERE ev.series = pr.series), 999) AS distance FROM pr""")(
    lambda s, d: (lambda e: X.nearest_distance(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), ["series"], "step", 86_400.0))(
        B.table(s, d, "events").select(F.col("event_type").alias("series"), F.expr(f"{B._micros()} div 1000000").alias("step"), "event_id")))
register("proximity", """WITH st AS (SELECT DISTINCT l_orderkey AS series, CAST(l_quantity AS BIGINT) AS step FROM lineitem), tg AS (SELECT DISTINCT l_orderkey AS series, CAST(l_quantity AS BIGINT) AS step FROM lineitem WHERE l_linenumber = 1)
 SELECT st.series, st.step, CASE WHEN bool_or(tg.step = st.step) THEN 1e0 WHEN bool_or(abs(tg.step - st.step) = 1) THEN 45e-2 ELSE 0e0 END AS proximity FROM st LEFT JOIN tg ON tg.series = st.series GROUP BY 1, 2""")(
    lambda s, d: (lambda e: X.proximity(e, e.where("l_linenumber = 1"), ["series"], "step", 0.45))(
        B.table(s, d, "lineitem").selectExpr("l_orderkey AS series", "CAST(l_quantity AS BIGINT) AS step", "l_linenumber")))

# -- alignment ----------------------------------------------------------------
DIFF_NAMES = ["easy", "Medium", "hard", "insane", "unheard"]
STYLE_SETS = [["Flow", "Sync-heavy"], ["dense"], ["technical", "FLOW", "dense"], [], ["wave-heavy"]]


def profile_inputs(s: SparkSession, d: str):
    """Per series: onsets, energy, beats and the report row with controls attached."""
    on, e = onsets_and_energy(s, d)
    bpm, lengths = X.tempo(on, e), X.durations(e)
    grid = X.beat_grid(bpm, on, lengths)
    styles = "array(" + ", ".join("array(" + ", ".join(f"'{x}'" for x in st) + ")" if st else "CAST(array() AS array<string>)" for st in STYLE_SETS) + ")"
    names = "array(" + ", ".join(f"'{n}'" for n in DIFF_NAMES) + ")"
    report = lengths.join(bpm, "series").select("series", "duration", "bpm", F.expr(f"element_at({names}, int(series) + 1)").alias("difficulty"),
                                               F.expr(f"element_at({styles}, int(series) + 1)").alias("styles"))
    profile = stage(L.step_profile(report))
    beat_steps, onset_steps = stage(L.steps_of(grid, profile)), stage(L.steps_of(on, profile))
    return e, profile, beat_steps, onset_steps


PROF = """prof0 AS (SELECT series, duration, bpm, greatest(8e-2, 60 / bpm / 2) AS step_seconds, [58e-2, 76e-2, 96e-2, 116e-2, 96e-2][CAST(series AS INT) + 1] + [8e-2, 22e-2, 34e-2, -4e-2, 0e0][CAST(series AS INT) + 1] AS dens,
   [3e-2, 8e-2, 1e-1, -2e-2, 0e0][CAST(series AS INT) + 1] AS rate FROM dur JOIN tempo USING (series)),
 prof1 AS (SELECT *, CAST(greatest(24, floor(duration / step_seconds)) AS BIGINT) AS steps FROM prof0),
 prof2 AS (SELECT *, CAST(greatest(90, least(360, floor(steps * (165e-2 + dens * 45e-2)))) AS BIGINT) AS target_tokens FROM prof1),
 prof AS (SELECT *, CAST(greatest(36, least(target_tokens - 8, floor(target_tokens * 38e-2))) AS BIGINT) AS min_tokens, greatest(35e-2, least(175e-2, dens)) AS density FROM prof2),
 bst AS (SELECT DISTINCT series, CAST(greatest(0, round_even(t / step_seconds, 0)) AS BIGINT) AS step FROM beat JOIN prof USING (series)),
 ost AS (SELECT DISTINCT series, CAST(greatest(0, round_even(t / step_seconds, 0)) AS BIGINT) AS step FROM onset JOIN prof USING (series)),
 far AS (SELECT series, greatest(steps, coalesce((SELECT max(step) FROM bst b WHERE b.series = p.series), 0), coalesce((SELECT max(step) FROM ost b WHERE b.series = p.series), 0)) + 1 AS last FROM prof p),
 eng AS (SELECT series, step, (SELECT value FROM smooth s WHERE s.series = g.series ORDER BY abs(s.t - g.t), s.t LIMIT 1) AS energy FROM (SELECT far.series, step, step * step_seconds AS t FROM far JOIN prof USING (series), range(0, 5000) r(step) WHERE step <= last) g),
 grid AS (SELECT series, min(step) AS first, CASE WHEN count(*) > 1 THEN greatest(1, CAST(round_even((max(step) - min(step)) / (count(*) - 1), 0) AS BIGINT)) ELSE 2 END AS iv FROM bst GROUP BY 1)"""
prof = lambda final: more("beat", "smooth") + PROF + " " + final
register("step_profile", prof("""SELECT series, round(duration, 6) AS duration, bpm, round(step_seconds, 6) AS step_seconds, steps, target_tokens, min_tokens, round(density, 6) AS density,
 'START ' || ['DIFF_EASY', 'DIFF_MEDIUM', 'DIFF_HARD', 'DIFF_INSANE', 'DIFF_HARD'][CAST(series AS INT) + 1] || ' ALIGN_UNKNOWN' AS prefix, ['BLOCK=108 ORB_BLUE=122 ORB_YELLOW=128 PLATFORM=108 SAW=85 SPEED_FAST=118 SPIKE=115', 'BLOCK=112 ORB_YELLOW=112 SPIKE=118',
  'BLOCK=112 GRAVITY_DOWN=118 GRAVITY_UP=118 ORB_BLACK=125 ORB_BLUE=130 ORB_YELLOW=112 PLATFORM=108 SAW=85 SPIKE=118', 'BLOCK=108 PLATFORM=108 SAW=85', 'BLOCK=85 PLATFORM=90 PORTAL_WAVE=220 SPIKE=120'][CAST(series AS INT) + 1] AS bias FROM prof"""))(
    lambda s, d: profile_inputs(s, d)[1].select("series", F.round("duration", 6).alias("duration"), "bpm", *r6("step_seconds"), "steps", "target_tokens", "min_tokens", *r6("density"), F.array_join("prefix", " ").alias("prefix"),
        F.expr("array_join(transform(array_sort(map_entries(bias)), e -> concat(e.key, '=', cast(round(e.value * 100, 0) as bigint))), ' ')").alias("bias")))
register("beat_steps", prof("SELECT series, step FROM bst"))(lambda s, d: profile_inputs(s, d)[2])
register("onset_steps", prof("SELECT series, step FROM ost"))(lambda s, d: profile_inputs(s, d)[3])
register("energy_by_step", prof("SELECT series, step, round(energy, 6) AS energy FROM eng"))(
    lambda s, d: L.energy_by_step(*profile_inputs(s, d)).select("series", "step", *r6("energy")))


LINE_STYLES = ["flow", "dense", "technical", "jump-heavy", "wave-heavy", "ship-focused", "sync-heavy"]
TASK_ROWS = 1 << 19


def line_styles(s: SparkSession, d: str) -> DataFrame:
    """The style of each (level, ordinal) of ``lineitem``, the greatest by name; by its place in the order of names, as numbers are hashed and text is sorted."""
    order = sorted(LINE_STYLES)
    places = ", ".join(str(order.index(n)) for n in LINE_STYLES)
    lines = B.table(s, d, "lineitem")
    # a task's groups do not grow with the table; what bias_table groups by level stays where it is
    parts = max(s.sparkContext.defaultParallelism, -(-lines.count() // TASK_ROWS))
    rows = lines.select(F.col("l_orderkey").alias("level_id"), F.col("l_linenumber").alias("ordinal"), F.expr(f"array({places})[int(l_suppkey % 7)]").alias("_place"))
    each = rows.repartition(parts, "level_id").groupBy("level_id", "ordinal").agg(F.max("_place").alias("_place"))
    return each.select("level_id", "ordinal", F.expr(f"array({', '.join(repr(n) for n in order)})[_place]").alias("style"))


register("bias_table", f"""WITH st AS (SELECT l_orderkey, l_linenumber AS ordinal, ['flow', 'dense', 'technical', 'jump-heavy', 'wave-heavy', 'ship-focused', 'sync-heavy'][l_suppkey % 7 + 1] AS style FROM lineitem),
 b(style, token, m) AS (VALUES {style_values(STYLE_BIAS)}) SELECT l_orderkey AS level_id, token, arg_max(m, ordinal * 1000 + 0) AS multiplier FROM (SELECT l_orderkey, ordinal, max(style) AS style FROM st GROUP BY 1, 2) JOIN b USING (style) GROUP BY 1, 2""")(
    lambda s, d: L.bias_table(line_styles(s, d), ["level_id"]))
register("expand_grid", prof("SELECT series, step FROM bst JOIN prof USING (series) WHERE step <= steps UNION SELECT series, first + k * iv FROM grid JOIN prof USING (series), range(0, 5000) r(k) WHERE first + k * iv <= steps"))(
    lambda s, d: (lambda i: L.expand_grid(i[2], i[1].select("series", F.col("steps").alias("limit"))))(profile_inputs(s, d)))

SYNC = ", " + PROF + f""", sx AS (SELECT o.level_id, o.level_id % 5 AS series, o.x_step AS step, len(list_filter(tokens, lambda t: t = 'STEP')) AS lim FROM sobj o JOIN seqt USING (level_id) WHERE NOT (o.token IN ({SOLID}) AND o.y_lane <= 0)),
 dist AS (SELECT DISTINCT series, step, lim FROM sx),
 ds AS (SELECT series, step, lim, coalesce(least((SELECT min(abs(b.step - d.step)) FROM bst b WHERE b.series = d.series AND b.step <= lim),
   (SELECT min(abs(first + k * iv - d.step)) FROM grid g, range(0, 2000) r(k) WHERE g.series = d.series AND first + k * iv <= lim)), 999) AS b,
   coalesce((SELECT min(abs(b.step - d.step)) FROM ost b WHERE b.series = d.series), 999) AS f FROM dist d),
 syn AS (SELECT s.level_id, count(ds.b) AS scored_objects, count(*) FILTER (ds.b = 0) AS beat_aligned_objects, count(*) FILTER (ds.f = 0) AS onset_aligned_objects, count(*) FILTER (least(ds.b, ds.f) <= 1) AS synced_objects
   FROM seqt s LEFT JOIN sx USING (level_id) LEFT JOIN ds ON ds.series = sx.series AND ds.step = sx.step AND ds.lim = sx.lim GROUP BY 1),
 sync AS (SELECT *, scored_objects - synced_objects AS unsynced_objects, round(1e2 * synced_objects / greatest(scored_objects, 1), 6) AS sync_score FROM syn)"""


def sync_inputs(s: SparkSession, d: str):
    seqs = stage(emitted(s, d).withColumn("series", F.col("level_id") % 5))
    _, _, beat_steps, onset_steps = profile_inputs(s, d)
    return seqs, L.sync_counts(seqs, beat_steps, onset_steps)


SYNC_HEAD = sql("", "sgram", "beat", "smooth").rstrip()
register("sync_score", SYNC_HEAD + SYNC + " SELECT * FROM sync")(lambda s, d: sync_inputs(s, d)[1])
FLOW_NEXT = f"""CASE WHEN o.token IN ({SOLID}) THEN CASE WHEN o.y_lane <= 0 THEN a.lane WHEN o.y_lane <= a.lane AND o.y_lane + 1 >= a.lane THEN greatest(a.lane, o.y_lane + 1) WHEN o.y_lane < a.lane THEN greatest(1, o.y_lane + 1) ELSE a.lane END
   WHEN o.token IN ({q(LEX.orbs)}) THEN greatest(greatest(1, a.lane - 2), least(least(15, a.lane + 2), o.y_lane)) WHEN o.token IN ({q(LEX.pads)}) THEN greatest(1, least(15, o.y_lane + 1))
   WHEN o.token IN ({q(LEX.hazards)}) THEN greatest(1, least(15, a.lane - 2)) ELSE a.lane END"""
FLOWWALK = f""", fo AS (SELECT *, row_number() OVER (PARTITION BY level_id ORDER BY sequence) AS r FROM sobj WHERE NOT (token IN ({SOLID}) AND y_lane <= 0)),
 fw AS (WITH RECURSIVE w AS (SELECT level_id, CAST(0 AS BIGINT) AS r, CAST(1 AS BIGINT) AS lane, CAST(0 AS BIGINT) AS jump FROM seqt
   UNION ALL SELECT level_id, r, CAST(nl AS BIGINT), CAST(CASE WHEN r = 1 THEN 0 ELSE abs(nl - lane) END AS BIGINT) FROM (SELECT o.level_id, o.r, a.lane, {FLOW_NEXT} AS nl FROM w a JOIN fo o ON o.level_id = a.level_id AND o.r = a.r + 1)) SELECT level_id, max(jump) AS jump FROM w GROUP BY 1)"""
register("flow_path", sql("", "sgram").rstrip() + FLOWWALK + " SELECT level_id, jump AS max_lane_jump FROM fw")(
    lambda s, d: G.with_objects(emitted(s, d)).select("level_id", L.max_lane_jump("objects").alias("max_lane_jump")))


@register("flow_score", SYNC_HEAD + quality_sql("seqt", "s") + FLOWWALK + SYNC + """,
 fl AS (SELECT level_id, object_count, sync_score, greatest(0e0, least(1e2, 1e2 - 1e1 * greatest(0, jump - 2) - 18e0 * path_obstructions - 8e0 * duplicate_positions - 1e1 * greatest(0, max_objects_per_step - 2) - 1e1 * control_spam - 8e0 * path_jumps)) AS flow
   FROM squality JOIN sync USING (level_id) JOIN fw USING (level_id))
 SELECT level_id, CASE WHEN object_count > 0 THEN sync_score ELSE 0 END AS sync_score, round(CASE WHEN object_count > 0 THEN flow ELSE 0 END, 6) AS flow_score, round(CASE WHEN object_count > 0 THEN sync_score * 58e-2 + flow * 42e-2 ELSE 0 END, 6) AS flow_score_total FROM fl""")
def flow_score(s: SparkSession, d: str) -> DataFrame:
    seqs, sync = sync_inputs(s, d)
    return L.flow_report(seqs, Q.quality_report(seqs).drop("errors"), sync).select("level_id", "sync_score", *r6("flow_score", "flow_score_total"))


PLAN = """, plan AS (SELECT series, greatest(18, least((SELECT max(step) FROM eng e WHERE e.series = p.series), greatest(18, floor(target_tokens * 66e-2)), 620)) AS planned FROM prof p),
 wanted AS (SELECT series, step, 2e0 AS b, 1e0 AS g FROM (SELECT series, step FROM bst JOIN plan USING (series) WHERE step <= planned UNION SELECT series, first + k * iv FROM grid JOIN plan USING (series), range(0, 5000) r(k) WHERE first + k * iv <= planned)
   UNION ALL SELECT series, step, 4e0, 14e-1 FROM ost),
 pri AS (SELECT series, step, max(b + g * energy) AS priority FROM wanted JOIN plan USING (series) JOIN eng USING (series, step) WHERE step >= 2 AND step < planned - 2 GROUP BY 1, 2)"""


def event_inputs(s: SparkSession, d: str):
    e, profile, beat_steps, onset_steps = profile_inputs(s, d)
    energies = stage(L.energy_by_step(e, profile, beat_steps, onset_steps))
    plans = stage(L.planned_steps(profile, energies))
    return L.event_step_priority(beat_steps, onset_steps, energies, plans), energies, plans


register("event_step_priority", prof(PLAN[0:0]) .rstrip() + PLAN + " SELECT series, step, round(priority, 6) AS priority FROM pri")(
    lambda s, d: event_inputs(s, d)[0].select("series", "step", *r6("priority")))
COUNT = """, cnt AS (SELECT series, CAST(planned AS BIGINT) AS steps, CAST(greatest(1, least(greatest(6, round_even(planned * greatest(30e-2, least(68e-2, 30e-2 + density * 18e-2 + rate)), 0)), greatest(1, floor((target_tokens - 3 - planned - 1) / 2)))) AS BIGINT) AS object_count FROM prof JOIN plan USING (series))"""
register("target_object_count", prof("").rstrip() + PLAN + COUNT + " SELECT series, steps, object_count FROM cnt")(
    lambda s, d: (lambda i: L.target_object_count(i[2], F.col("planned")))(event_inputs(s, d)))


#: The walk itself, step by step in order of priority; ties by a digest that both engines have.
SPACED = """, ord AS (SELECT series, step, row_number() OVER (PARTITION BY series ORDER BY round(priority, 6) DESC, md5(series || ':' || step)) AS r FROM pri),
 walk AS (WITH RECURSIVE w AS (SELECT DISTINCT series, CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS taken FROM ord UNION ALL
   SELECT w.series, o.r, CASE WHEN list_contains(taken, o.step - 1) OR list_contains(taken, o.step + 1) THEN taken ELSE list_append(taken, CAST(o.step AS BIGINT)) END FROM w JOIN ord o ON o.series = w.series AND o.r = w.r + 1)
   SELECT series, arg_max(taken, r) AS taken FROM w GROUP BY series),
 spaced AS (SELECT series, unnest(taken[1:object_count]) AS step, 'spaced' AS stage FROM walk JOIN cnt USING (series)),
 room AS (SELECT series, CAST(unnest(range(2, CAST(planned AS BIGINT) - 2)) AS BIGINT) AS step FROM plan),
 fill AS (SELECT f.series, f.step, 'fill' AS stage, row_number() OVER (PARTITION BY f.series ORDER BY coalesce(round(e.energy, 6), 35e-2) DESC, md5(f.series || ':' || f.step)) AS r FROM room f
   LEFT JOIN spaced s ON s.series = f.series AND s.step = f.step LEFT JOIN eng e ON e.series = f.series AND e.step = f.step WHERE s.step IS NULL)
 SELECT series, step, stage FROM spaced UNION ALL SELECT series, step, stage FROM fill JOIN cnt USING (series)
   WHERE r <= object_count - (SELECT count(*) FROM spaced s WHERE s.series = fill.series)"""


@register("spaced_top_k", prof("").rstrip() + PLAN + COUNT + SPACED)
def spaced_top_k(s: SparkSession, d: str) -> DataFrame:
    priorities, energies, plans = event_inputs(s, d)
    six = lambda rows, name: rows.withColumn(name, F.round(name, 6))
    tie = F.md5(F.concat_ws(":", F.col("series").cast("string"), F.col("step").cast("string")).cast("binary"))
    return L.spaced_top_k(six(priorities, "priority"), six(energies, "energy"), plans, L.target_object_count(plans, F.col("planned")), tie=tie)


# -- layouts ------------------------------------------------------------------
PLACED = f""", canon(token, cid) AS (VALUES {LEX.canonical_values()}), placed AS (SELECT o.*, CAST(coalesce(cid, 1) AS BIGINT) AS object_id, CAST(15 + 30 * x_step AS BIGINT) AS x, CAST(15 + 30 * y_lane AS BIGINT) AS y FROM sobj o LEFT JOIN canon USING (token)),
 clamped AS (SELECT level_id, sequence, token, x_step, object_id, x, l AS y_lane, CAST(15 + 30 * l AS BIGINT) AS y, CASE WHEN token IN ({SOLID}) THEN greatest(1, least(8, width)) ELSE width END AS width FROM (
   SELECT *, CASE WHEN token IN ({q(LEX.orbs + LEX.pads + LEX.hazards)}) THEN greatest(1, least(9, y_lane)) WHEN token IN ({q(LEX.control)}) THEN greatest(2, least(9, y_lane)) ELSE y_lane END AS l FROM placed WHERE NOT (token IN ({SOLID}) AND y_lane > 5))),
 cellp AS (SELECT *, unnest(range(0, CASE WHEN token IN ({SOLID}) THEN greatest(1, width) ELSE 1 END)) AS d FROM clamped),
 strs AS (SELECT level_id, '1,' || object_id || ',2,' || (x + d * 30) || ',3,' || y AS object_string, min(row(x_step, y_lane, sequence, d)) AS ord FROM cellp GROUP BY 1, 2)"""
placed = lambda s, d: P.place_objects(G.reconstruct(emitted(s, d)))
clamped = lambda s, d: P.clamp_by_class(placed(s, d))
lay = lambda final: sql("", "sgram").rstrip() + PLACED + " " + final
COLS = "level_id, sequence, token, CAST(x_step AS BIGINT) AS x_step, y_lane, width, object_id, x, y"
names = [c.split(" AS ")[-1] for c in COLS.split(", ")]
register("place_objects", lay(f"SELECT {COLS} FROM placed"))(lambda s, d: placed(s, d).select(*names))
register("clamp_by_class", lay(f"SELECT {COLS} FROM clamped"))(lambda s, d: clamped(s, d).select(*names))
register("object_strings", lay("SELECT level_id, object_string FROM strs"))(lambda s, d: P.object_strings(clamped(s, d)).drop("ord"))
register("layout_bounds", lay("SELECT level_id, CAST(max(x_step + greatest(1, width)) AS BIGINT) AS width_steps, CAST(max(y_lane) + 1 AS BIGINT) AS height_lanes FROM clamped GROUP BY 1"))(
    lambda s, d: P.layout_bounds(clamped(s, d)))
register("export_level_strings", lay("SELECT level_id, 'kS38,;' || string_agg(object_string, ';' ORDER BY ord) || ';' AS level_string FROM strs GROUP BY 1"))(
    lambda s, d: P.export_level_strings(P.object_strings(clamped(s, d)), "kS38,"))
register("layout_checks", lay("SELECT s.level_id, CASE WHEN NOT EXISTS (SELECT 1 FROM clamped c WHERE c.level_id = s.level_id) THEN 'no_gameplay_objects' END AS failure FROM seqs s"))(
    lambda s, d: (lambda c: P.layout_checks(B.levels(s, d), c, P.object_strings(c)))(stage(clamped(s, d))))
#: The rule object by object, with every occupied cell (step * 64 + lane) in a list.
ADMIT = f""", ao AS (SELECT *, row_number() OVER (PARTITION BY level_id ORDER BY x_step, sequence) AS r, token IN ({SOLID}) AS solid, x_step * 64 + y_lane AS cell, token || ':' || x_step || ':' || y_lane AS spot,
   CASE WHEN token IN ({q(LEX.portals)}) THEN 1 WHEN token IN ({q(LEX.gravity)}) THEN 2 WHEN token IN ({q(LEX.control)}) THEN 3 ELSE 0 END AS mark FROM clamped),
 adm AS (WITH RECURSIVE w AS (SELECT level_id, CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS sequence, CAST(-1 AS BIGINT) AS step, false AS column_taken, CAST(0 AS BIGINT) AS others, CAST([] AS BIGINT[]) AS occ,
     CAST([-999, -999, -999] AS BIGINT[]) AS last, CAST([] AS VARCHAR[]) AS seen, CAST(NULL AS BIGINT) AS got FROM (SELECT DISTINCT level_id FROM clamped)
   UNION ALL SELECT level_id, r, sequence, x_step, (same AND column_taken) OR (solid AND ok), CASE WHEN same THEN others ELSE 0 END + CASE WHEN ok AND NOT solid THEN 1 ELSE 0 END,
     CASE WHEN ok AND solid THEN list_concat(occ, list_transform(range(0, least(width, room)), lambda k: cell + 64 * k)) WHEN ok AND mark = 0 THEN list_append(occ, cell) ELSE occ END,
     CASE WHEN ok AND mark > 0 THEN [CASE WHEN mark = 1 THEN x_step ELSE last[1] END, CASE WHEN mark = 2 THEN x_step ELSE last[2] END, CASE WHEN mark = 3 THEN x_step ELSE last[3] END] ELSE last END,
     CASE WHEN ok AND NOT solid THEN list_append(seen, spot) ELSE seen END, CASE WHEN ok THEN CASE WHEN solid THEN least(width, room) ELSE width END END
   FROM (SELECT *, CASE WHEN solid THEN NOT (same AND column_taken) AND room > 0 ELSE NOT (same AND others >= 2) AND (mark = 0 OR x_step - last[mark] >= 8) AND (mark > 0 OR NOT list_contains(occ, cell)) AND NOT list_contains(seen, spot) END AS ok
     FROM (SELECT o.level_id, o.r, o.sequence, CAST(o.x_step AS BIGINT) AS x_step, CAST(o.cell AS BIGINT) AS cell, o.spot, o.solid, o.mark, CAST(o.width AS BIGINT) AS width, o.x_step = w.step AS same, w.column_taken, w.others, w.occ, w.last, w.seen,
       CAST(len(list_filter(range(0, CAST(greatest(1, o.width) AS BIGINT)), lambda k: NOT list_contains(w.occ, CAST(o.cell + 64 * k AS BIGINT)))) AS BIGINT) AS room FROM w JOIN ao o ON o.level_id = w.level_id AND o.r = w.r + 1)))
   SELECT level_id, sequence, got FROM w WHERE r > 0 AND got IS NOT NULL)"""
register("admit_objects", lay("X").removesuffix(" X") + ADMIT + " SELECT c.level_id, c.sequence, token, CAST(x_step AS BIGINT) AS x_step, y_lane, CAST(got AS BIGINT) AS width, object_id, x, y FROM clamped c JOIN adm USING (level_id, sequence)")(
    lambda s, d: P.admit_objects(clamped(s, d)).select(*names).withColumn("width", F.col("width").cast("bigint")))
register("control_spacing", sql("", "sgram").rstrip() + PLACED + f""", ctl AS (SELECT level_id, CASE WHEN token IN ({q(LEX.portals)}) THEN 'portal' WHEN token IN ({q(LEX.gravity)}) THEN 'gravity' ELSE 'speed' END AS category, x_step, sequence, token FROM sobj WHERE token IN ({q(LEX.control)})),
 """ + gap_sql("ctl", "level_id, category", "x_step", "8", "kept") + " SELECT level_id, category, CAST(x_step AS BIGINT) AS x_step, arg_min(token, sequence) AS token, min(sequence) AS sequence FROM kept JOIN ctl USING (level_id, category, x_step) GROUP BY 1, 2, 3")(
    lambda s, d: P.control_spacing(G.reconstruct(emitted(s, d))))


@register("export_report", lay("SELECT s.level_id, CAST(len(tokens) AS BIGINT) AS tokens_generated, (SELECT count(*) FROM strs x WHERE x.level_id = s.level_id) AS objects_generated, CAST(len(list_filter(tokens, lambda t: t = 'STEP')) AS BIGINT) AS step_count, '' AS warnings, CAST(0 AS BIGINT) AS invalid_tokens_skipped FROM seqt s"))
def export_report(s: SparkSession, d: str) -> DataFrame:
    seqs = stage(emitted(s, d))
    strings = P.object_strings(P.clamp_by_class(P.place_objects(G.reconstruct(seqs))))
    return P.export_report(seqs, strings, G.generation_validity(seqs)).withColumn("warnings", text("warnings"))


TXT = "txt AS (SELECT l_orderkey * 8 + l_linenumber AS id, CASE l_linenumber WHEN 1 THEN '1,' || l_partkey || ',2,3,3,4' WHEN 2 THEN '1,0,2,3,3,4' WHEN 3 THEN '1,5,2,3' WHEN 4 THEN '1,5,2,3,3,4,9' WHEN 5 THEN '1,5,2,x,3,4' WHEN 6 THEN '1,7,2,-1.5,3,2.25,1,0' ELSE '2,1,3,4,1,9.7' END AS raw, l_linenumber AS n, l_partkey AS pk FROM ol)"
lines = lambda s, d: B.order_lines(s, d).select(F.expr("l_orderkey * 8 + l_linenumber").alias("id"), F.expr(
    "CASE l_linenumber WHEN 1 THEN concat('1,', l_partkey, ',2,3,3,4') WHEN 2 THEN '1,0,2,3,3,4' WHEN 3 THEN '1,5,2,3' WHEN 4 THEN '1,5,2,3,3,4,9' WHEN 5 THEN '1,5,2,x,3,4' WHEN 6 THEN '1,7,2,-1.5,3,2.25,1,0' ELSE '2,1,3,4,1,9.7' END").alias("raw"), F.col("l_quantity"), "l_discount")
register("valid_object_string", more("ol") + TXT + " SELECT id, n IN (1, 7) AND NOT (n = 1 AND pk = 0) AS valid FROM txt")(lambda s, d: lines(s, d).select("id", P.valid_object_string("raw").alias("valid")))
register("parse_reference_object", more("ol") + TXT + " SELECT id, CAST(CASE n WHEN 1 THEN pk WHEN 2 THEN 0 WHEN 4 THEN 5 ELSE 0 END AS BIGINT) AS object_id, CASE WHEN n = 6 THEN -15e-1 ELSE 3e0 END AS x, CASE WHEN n = 6 THEN 225e-2 ELSE 4e0 END AS y FROM txt WHERE n IN (1, 2, 4, 6)")(
    lambda s, d: P.parse_reference_objects(lines(s, d)).select("id", "object_id", "x", "y"))
register("rewrite_property", more("ol") + TXT + """, v AS (SELECT *, q + dd * 1e-2 AS v FROM txt JOIN (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS q, l_discount AS dd FROM ol) USING (id)),
 f AS (SELECT *, CASE WHEN abs(v - round_even(v, 0)) < 1e-3 THEN CAST(CAST(round_even(v, 0) AS BIGINT) AS VARCHAR) ELSE rtrim(rtrim(printf('%.3f', v), '0'), '.') END AS s FROM v)
 SELECT id, CASE n WHEN 1 THEN '1,' || pk || ',2,' || s || ',3,4' WHEN 2 THEN '1,0,2,' || s || ',3,4' WHEN 3 THEN '1,5,2,' || s WHEN 4 THEN '1,5,2,' || s || ',3,4,9' WHEN 5 THEN '1,5,2,' || s || ',3,4' WHEN 6 THEN '1,7,2,' || s || ',3,2.25,1,0' ELSE '2,' || s || ',3,4,1,9.7' END AS raw FROM f""")(
    lambda s, d: lines(s, d).select("id", P.rewrite_property("raw", "2", F.col("l_quantity") + F.col("l_discount") * 0.01).alias("raw")))
CHUNK = f"""corpus AS (SELECT level_id % 5 AS level_id, object_id, x * 3e1 AS x, y, seq FROM obj),
 chunked AS (SELECT *, CAST(floor((x - min(x) OVER (PARTITION BY level_id)) / 96e1) AS BIGINT) AS chunk FROM corpus),
 sc0 AS (SELECT level_id, chunk, count(*) AS n_objects, count(DISTINCT object_id) AS distinct_ids, count(*) FILTER (object_id IN ({q(LEX.interactive_ids)})) AS interactive,
   count(*) FILTER (object_id IN (SELECT object_id FROM omap)) AS known, min(x) AS min_x, min(y) AS lo, max(y) AS hi FROM chunked GROUP BY 1, 2),
 scored AS (SELECT level_id, chunk, n_objects, distinct_ids, interactive, known, min_x, round(26e-1 * interactive + 18e-2 * known + 8e0 * least(n_objects / 32, 45e-1) + 14e-1 * distinct_ids - greatest(0, (hi - lo - 72e1) / 3e1) - greatest(0, (hi - 96e1) / 6e1), 6) AS score
   FROM sc0 WHERE n_objects >= 24 AND (interactive >= 4 OR distinct_ids >= 4)),
 sel AS (SELECT *, row_number() OVER (ORDER BY score DESC, (level_id * 31 + chunk * 7) % 101, level_id, chunk) - 1 AS ordinal FROM scored ORDER BY score DESC, (level_id * 31 + chunk * 7) % 101, level_id, chunk LIMIT 7),
 st AS (SELECT sel.ordinal, c.level_id, c.object_id, coalesce(token, 'OBJ_' || c.object_id) AS token, 15e0 + ordinal * 96e1 + (c.x - min_x) AS x, c.y, row_number() OVER (ORDER BY ordinal, c.x, c.y, c.object_id) - 1 AS sequence FROM chunked c JOIN sel USING (level_id, chunk) LEFT JOIN omap USING (object_id))"""
chunk_sql = lambda final: more("obj", "omap") + CHUNK + " " + final
register("chunk_score", chunk_sql("SELECT level_id, chunk, n_objects, distinct_ids, CAST(interactive AS BIGINT) AS interactive, CAST(known AS BIGINT) AS known, score FROM scored"))(
    lambda s, d: P.score_chunks(P.chunk_objects(B.chunk_corpus(s, d))).drop("min_x"))
tie = lambda: F.expr("(level_id * 31 + chunk * 7) % 101")
register("select_chunks", chunk_sql("SELECT level_id, chunk, score, ordinal FROM sel"))(
    lambda s, d: P.select_chunks(P.score_chunks(P.chunk_objects(B.chunk_corpus(s, d))), 200, tie()).select("level_id", "chunk", "score", "ordinal"))
register("stitch", chunk_sql("SELECT sequence, ordinal, level_id, object_id, token, CAST(greatest(0, round_even(x / 3e1, 0)) AS BIGINT) AS x_step, CAST(round_even(y / 3e1, 0) AS BIGINT) AS y_lane, round(x, 6) AS x, y FROM st"))(
    lambda s, d: (lambda c: P.stitch(c, P.select_chunks(P.score_chunks(c), 200, tie())))(P.chunk_objects(B.chunk_corpus(s, d)).drop("raw", "seq")).withColumn("x", F.round("x", 6)))
register("stitch_layout", chunk_sql("""SELECT (SELECT 'kS38,;' || coalesce(string_agg(s, ';' ORDER BY first) || ';', '') FROM one) AS level_string, (SELECT count(*) FROM one) AS n_strings,
 (SELECT CAST(coalesce(max(greatest(0, round_even(x / 3e1, 0))), 0) + 1 AS BIGINT) FROM st) AS width_steps, (SELECT CAST(coalesce(max(round_even(y / 3e1, 0)), 0) + 1 AS BIGINT) FROM st) AS height_lanes""").replace(
    " SELECT (SELECT 'kS38", """, one AS (SELECT s, min(sequence) AS first FROM (SELECT sequence, '1,' || object_id || ',2,' || CASE WHEN abs(x - round_even(x, 0)) < 1e-3 THEN CAST(CAST(round_even(x, 0) AS BIGINT) AS VARCHAR)
   ELSE rtrim(rtrim(printf('%.3f', x), '0'), '.') END || ',3,' || y || ',21,1004' AS s FROM st) GROUP BY 1) SELECT (SELECT 'kS38""", 1))(
    lambda s, d: (lambda c: P.stitched_layout(stage(P.stitch(c, P.select_chunks(P.score_chunks(c), 200, tie()))), "kS38,"))(P.chunk_objects(B.chunk_corpus(s, d)).drop("seq")))
