"""Registered queries over objects and token sequences, each with its check SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanestride.dims import DEFAULT as LEX
from lanestride.operators import analytics as A, emit as E, grammar as G, objects as O, quality as Q, vocabulary as V
from lanestride.plans import bindings as B
from lanestride.plans.oracle import MECH, SOLID, VOCAB, q, sql
from lanestride.session import stage

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, text: str | None):
    def add(fn):
        QUERIES[name] = fn
        if text is not None:
            SQL[name] = text
        return fn
    return add


def gameplay(spark: SparkSession, sf: str) -> DataFrame:
    return O.gameplay_objects(B.objects(spark, sf))


def emitted(spark: SparkSession, sf: str, limits: E.Limits = E.Limits()) -> DataFrame:
    return E.emit_tokens(gameplay(spark, sf), B.levels(spark, sf), limits=limits)


def stats(spark: SparkSession, sf: str) -> DataFrame:
    play = stage(gameplay(spark, sf))
    return E.stats_records(B.objects(spark, sf), play, E.emit_tokens(play, B.levels(spark, sf)))


text = lambda c: F.array_join(c, " ")
big = lambda c: F.col(c).cast("bigint").alias(c)

# -- objects ------------------------------------------------------------------
register("map_tokens", sql("SELECT level_id, seq, object_id, token FROM mapped", "mapped"))(
    lambda s, d: O.map_tokens(B.objects(s, d)).select("level_id", "seq", "object_id", "token"))
register("classify", sql("SELECT level_id, seq, object_id, token, object_class FROM cls", "cls"))(
    lambda s, d: O.classify_objects(B.objects(s, d)).select("level_id", "seq", "object_id", "token", "object_class"))
register("origins_p05", sql("SELECT level_id, n, round(x_origin, 6) AS x_origin, y_origin FROM org", "org"))(
    lambda s, d: O.origins(O.map_tokens(B.objects(s, d))).select("level_id", "n", F.round("x_origin", 6).alias("x_origin"), "y_origin"))
register("quantize", sql("SELECT level_id, seq, token, x_step, y_lane FROM quant", "quant"))(
    lambda s, d: O.quantize(O.map_tokens(B.objects(s, d))).select("level_id", "seq", "token", "x_step", "y_lane"))
register("first_per_cell", sql("SELECT level_id, token, y_lane, x_step, object_id FROM cells", "cells"))(
    lambda s, d: O.first_per_cell(O.quantize(O.map_tokens(B.objects(s, d)))).select("level_id", "token", "y_lane", "x_step", "object_id"))
register("merge_runs", sql("SELECT level_id, object_id, token, round(x, 6) AS x, round(y, 6) AS y, x_step, y_lane, width FROM runs", "runs"))(
    lambda s, d: gameplay(s, d).select("level_id", "object_id", "token", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "x_step", "y_lane", "width"))
register("event_order", sql("SELECT level_id, CAST(rank AS BIGINT) AS rank, token, x_step, y_lane, 'Y' || y_lane AS lane_token, CASE WHEN rank < 2 THEN 'WIDTH_' || width END AS width_token FROM rruns", "rruns"))(
    lambda s, d: O.event_order(gameplay(s, d)).select("level_id", big("rank"), "token", "x_step", "y_lane", O.lane_token(F.col("y_lane")).alias("lane_token"),
                                                      F.when(F.col("token").isin(*LEX.solids), O.width_token(F.col("width"))).alias("width_token")))
register("difficulty_token", sql("SELECT level_id, difficulty, difftok AS token FROM lvl", "lvl"))(
    lambda s, d: B.levels(s, d).select("level_id", "difficulty", O.difficulty_token("difficulty").alias("token")))
register("level_extent", sql("SELECT level_id, count(*) AS object_count_raw, round(min(x), 6) AS x_min, round(max(x), 6) AS x_max, round(min(y), 6) AS y_min, round(max(y), 6) AS y_max FROM obj GROUP BY 1", "obj"))(
    lambda s, d: O.level_extent(B.objects(s, d), B.levels(s, d)))
register("id_histogram", sql("SELECT level_id, string_agg(object_id || ':' || c, ' ' ORDER BY c DESC, object_id) AS histogram FROM (SELECT level_id, object_id, count(*) AS c FROM obj GROUP BY 1, 2) GROUP BY 1", "obj"))(
    lambda s, d: O.id_histogram(B.objects(s, d)).select("level_id", F.expr("array_join(transform(object_id_counts, e -> concat(e.object_id, ':', e.count)), ' ')").alias("histogram")))
register("object_stats", sql("SELECT o.*, top FROM ostat o LEFT JOIN (SELECT level_id, string_agg(object_id || ':' || count, ' ' ORDER BY count DESC, object_id) AS top FROM unk GROUP BY 1) USING (level_id)", "ostat"))(
    lambda s, d: O.object_stats(B.objects(s, d)).withColumn("top", F.expr("array_join(transform(top_unknown_object_ids, e -> concat(e.object_id, ':', e.count)), ' ')")).drop("top_unknown_object_ids"))

# -- emission -----------------------------------------------------------------
register("emit_tokens", sql("SELECT level_id, txt AS tokens FROM seqs", "emit"))(
    lambda s, d: emitted(s, d).select("level_id", text("tokens").alias("tokens")))
register("token_length_cap", sql("SELECT level_id, txt AS tokens, CASE WHEN over THEN 'absurd_token_length' END AS emit_error FROM seqs", "emit60"))(
    lambda s, d: emitted(s, d, E.Limits(max_token_length=60)).select("level_id", text("tokens").alias("tokens"), "emit_error"))
register("token_rows", sql("SELECT level_id, CAST(generate_subscripts(tokens, 1) - 1 AS BIGINT) AS pos, unnest(tokens) AS token FROM seqt", "emit"))(
    lambda s, d: E.token_rows(emitted(s, d)).select("level_id", big("pos"), "token"))
register("reject_reason", sql("SELECT level_id, reason = '' AS accepted, reason, object_count_raw, object_count_gameplay, unknown_object_ratio, token_count, unique_x_steps FROM stats", "stats"))(
    lambda s, d: stats(s, d).select("level_id", "accepted", "reason", "object_count_raw", "object_count_gameplay", "unknown_object_ratio", "token_count", "unique_x_steps"))
register("run_summary", sql("""SELECT count(*) AS levels_seen, count(*) FILTER (reason = '') AS levels_accepted, count(*) FILTER (reason <> '') AS levels_rejected,
    CAST(coalesce(sum(token_count) FILTER (reason = ''), 0) AS BIGINT) AS tokens_total, round(coalesce(sum(token_count) FILTER (reason = ''), 0) / greatest(count(*) FILTER (reason = ''), 1), 6) AS avg_token_length,
    coalesce(max(token_count) FILTER (reason = ''), 0) AS max_token_length,
    round(coalesce(sum(len(list_filter(tokens, lambda t: t = 'STEP')) / token_count) FILTER (reason = ''), 0) / greatest(count(*) FILTER (reason = ''), 1), 6) AS avg_step_density,
    round(sum(unknown_object_count) / greatest(sum(object_count_raw), 1), 6) AS unknown_object_rate,
    (SELECT coalesce(string_agg(reason || '=' || n, ' ' ORDER BY reason), '') FROM (SELECT reason, count(*) AS n FROM stats WHERE reason <> '' GROUP BY 1)) AS rejection_reasons FROM stats""", "stats"))(
    lambda s, d: E.run_summary(stats(s, d)).withColumn("rejection_reasons", F.expr("array_join(transform(map_entries(rejection_reasons), e -> concat(e.key, '=', e.value)), ' ')")))

# -- grammar ------------------------------------------------------------------
register("reconstruct", sql("SELECT level_id, sequence, token, CAST(x_step AS BIGINT) AS x_step, y_lane, width FROM dobj", "dgram"))(
    lambda s, d: G.reconstruct(B.dirty(s, d)))
register("reconstruct_emitted", sql("SELECT level_id, sequence, token, CAST(x_step AS BIGINT) AS x_step, y_lane, width FROM sobj", "sgram"))(
    lambda s, d: G.reconstruct(emitted(s, d)))
register("grammar_errors", sql("SELECT level_id, count(err) AS n_errors, coalesce(string_agg(err, ' ' ORDER BY pos), '') AS errors FROM dirty LEFT JOIN derr USING (level_id) GROUP BY 1", "dgram"))(
    lambda s, d: G.with_errors(B.dirty(s, d)).select("level_id", F.size("errors").cast("bigint").alias("n_errors"), text("errors").alias("errors")))
register("grammar_errors_words", sql("""SELECT level_id, 1 + CASE WHEN tokens[-1] <> 'END' THEN 1 ELSE 0 END + len(tokens) - 1 AS n_errors, tokens[2] AS second FROM words WHERE len(tokens) > 0
    UNION ALL SELECT level_id, 1, NULL FROM words WHERE len(tokens) = 0""", "words"))(
    lambda s, d: G.with_errors(B.words(s, d)).select("level_id", F.size("errors").cast("bigint").alias("n_errors"), F.get("tokens", F.lit(1)).alias("second")))


def _records(play: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gameplay rows; every seventh level loses its last object and every eleventh is missing, to exercise the reasons."""
    rows = G.gameplay_rows(play).where("level_id % 11 <> 10")
    last = rows.groupBy("level_id").agg(F.max("sequence").alias("_last"))
    kept = rows.join(last, "level_id").where("level_id % 7 <> 6 OR sequence < _last").drop("_last")
    moved = F.expr("x_step + CASE WHEN level_id % 7 <> 6 AND level_id % 5 = 4 AND sequence = 3 THEN 1 ELSE 0 END")
    return kept.withColumn("x_step", moved), last


def roundtrip(s: SparkSession, d: str) -> DataFrame:
    play = stage(gameplay(s, d))
    return G.roundtrip_check(E.emit_tokens(play, B.levels(s, d)), *_records(play))


ROUND = """chk AS (SELECT s.level_id, (SELECT count(*) FROM sobj o WHERE o.level_id = s.level_id) AS n, coalesce((SELECT max(x_step) FROM sobj o WHERE o.level_id = s.level_id), 0) AS mx,
  s.level_id % 11 = 10 OR NOT EXISTS (SELECT 1 FROM runs r WHERE r.level_id = s.level_id) AS gone FROM seqs s),
 chk2 AS (SELECT *, CASE WHEN gone THEN 0 WHEN level_id % 7 = 6 THEN n - 1 ELSE n END AS want FROM chk),
 chk3 AS (SELECT *, CASE WHEN gone THEN 'missing_gameplay_record' WHEN want <> n THEN 'object_count_mismatch' WHEN level_id % 5 = 4 AND n > 3 THEN 'object_mismatch' ELSE '' END AS reason FROM chk2)"""
register("roundtrip", sql("", "sgram").rstrip() + ", " + ROUND + " SELECT level_id, reason = '' AS valid, reason, CAST(CASE WHEN reason = 'object_mismatch' THEN 3 ELSE -1 END AS BIGINT) AS mismatch_index, n AS reconstructed_object_count, want AS expected_object_count, CAST(mx AS BIGINT) AS max_x_step FROM chk3")(
    lambda s, d: roundtrip(s, d).drop("grammar_errors"))
register("roundtrip_summary", sql("", "sgram").rstrip() + ", " + ROUND + " SELECT count(*) AS levels_validated, count(*) FILTER (reason = '') AS levels_valid, count(*) FILTER (reason <> '') AS levels_invalid, (SELECT string_agg(reason || '=' || c, ' ' ORDER BY reason) FROM (SELECT reason, count(*) AS c FROM chk3 WHERE reason <> '' GROUP BY 1)) AS invalid_reasons FROM chk3")(
    lambda s, d: G.roundtrip_summary(roundtrip(s, d)).withColumn("invalid_reasons", F.expr("array_join(transform(map_entries(invalid_reasons), e -> concat(e.key, '=', e.value)), ' ')")))

REP = "SELECT level_id, CAST(max(c) AS BIGINT) AS max_repetition FROM (SELECT level_id, t, pos - r AS g, count(*) AS c FROM (SELECT *, row_number() OVER (PARTITION BY level_id, t ORDER BY pos) AS r FROM {0}k) GROUP BY ALL) GROUP BY 1"
register("max_repetition", sql("SELECT level_id, coalesce(max_repetition, 0) AS max_repetition FROM dirty LEFT JOIN (" + REP.format("d") + ") USING (level_id)", "dgram"))(
    lambda s, d: B.dirty(s, d).select("level_id", G.max_repetition("tokens").alias("max_repetition")))
register("transitions", sql("SELECT token, next_token, count(*) AS count FROM (SELECT t AS token, lead(t) OVER (PARTITION BY level_id ORDER BY pos) AS next_token FROM dk) WHERE next_token IS NOT NULL GROUP BY 1, 2", "dgram"))(
    lambda s, d: G.transition_counts(B.dirty(s, d)))
LEGAL = " OR ".join(f"(a, b) = ({q(p)})" for p in LEX.transitions())
register("illegal_transitions", sql("", "dgram").rstrip() + f""", heldk AS (SELECT level_id, pos, t, k, lag(t) OVER w AS after,
   arg_max(k, CASE WHEN k IN ('S', 'M', '+', 'B', 'A', 'D') THEN pos END) OVER (PARTITION BY level_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h FROM da WINDOW w AS (PARTITION BY level_id ORDER BY pos)),
 kinds AS (SELECT level_id, pos, t, after, CASE WHEN k = 'Y' THEN CASE WHEN coalesce(h, '') = 'S' THEN 'solid_lane' ELSE 'lane' END
   WHEN k = 'B' THEN 'start' WHEN k = 'D' THEN 'difficulty' WHEN k = 'A' THEN 'align' WHEN k = 'S' THEN 'solid' WHEN k = 'M' THEN 'mechanic' WHEN k = '+' THEN 'step' WHEN k = 'W' THEN 'width' WHEN k = 'E' THEN 'end' ELSE 'other' END AS b FROM heldk),
 runs_k AS (SELECT *, lag(b) OVER (PARTITION BY level_id ORDER BY pos) AS a, count(CASE WHEN b = 'step' THEN 1 END) OVER (PARTITION BY level_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS before FROM kinds)
 SELECT level_id, CAST(pos AS BIGINT) AS pos, after, t AS token FROM runs_k WHERE CASE WHEN pos = 0 THEN b <> 'start' ELSE NOT ({LEGAL}) OR (b = 'step' AND before = 2) OR (b = 'end' AND pos < 40 AND a <> 'other') END""")(
    lambda s, d: G.illegal_transitions(B.dirty(s, d), min_generated=40, max_consecutive_steps=2))
register("close_sequences", sql("", "dgram").rstrip() + """, tails AS (SELECT level_id, n, arg_max(t, pos) AS lastt, arg_max(k, pos) AS lastk FROM da GROUP BY 1, 2),
 prevm AS (SELECT level_id, arg_max(k, pos) AS pk FROM da WHERE pos < n - 1 AND k IN ('S', 'M', '+', 'B', 'A', 'D') GROUP BY 1)
 SELECT level_id, CASE WHEN lastt IS NULL THEN 'START DIFF_NA ALIGN_UNKNOWN STEP END' ELSE array_to_string(tokens || CASE WHEN lastk = 'S' THEN ['Y0', 'WIDTH_1'] WHEN lastk = 'M' THEN ['Y0'] WHEN lastk = 'Y' AND pk = 'S' THEN ['WIDTH_1'] WHEN lastk = 'D' THEN ['ALIGN_UNKNOWN'] ELSE [] END
   || CASE WHEN lastt = 'STEP' THEN [] ELSE ['STEP'] END || ['END'], ' ') END AS tokens FROM dirty LEFT JOIN tails USING (level_id) LEFT JOIN prevm USING (level_id)""")(
    lambda s, d: B.dirty(s, d).select("level_id", text(G.close_sequence("tokens")).alias("tokens")))
KNOWN = [t for i, t in enumerate(LEX.base_vocabulary) if i % 9 != 8]
register("generation_validity", sql("", "dgram").rstrip() + f""", strange AS (SELECT level_id, t FROM dk WHERE t NOT IN ({q(KNOWN)})),
 allerr AS (SELECT level_id, pos, err FROM derr UNION ALL SELECT level_id, 2000000000, 'unknown_token:' || t FROM (SELECT DISTINCT level_id, t FROM strange))
 SELECT d.level_id, count(err) = 0 AS valid, coalesce(string_agg(err, ' ' ORDER BY pos, err), '') AS errors, (SELECT count(*) FROM strange x WHERE x.level_id = d.level_id) AS invalid_token_count,
  round((SELECT count(*) FROM strange x WHERE x.level_id = d.level_id) / greatest(len(any_value(tokens)), 1), 6) AS invalid_token_rate FROM dirty d LEFT JOIN allerr e ON d.level_id = e.level_id GROUP BY 1""")(
    lambda s, d: G.generation_validity(B.dirty(s, d), known=tuple(KNOWN)).withColumn("errors", text("errors")))

# -- analytics ----------------------------------------------------------------
TC = "tc AS (SELECT t AS token, count(*) AS count FROM (SELECT unnest(tokens) AS t FROM {0}) GROUP BY 1)"
with_tc = lambda final, src, need: sql("", need).rstrip() + ", " + TC.format(src) + " " + final
register("token_counts", with_tc("SELECT * FROM tc", "words", "words"))(lambda s, d: A.token_counts(B.words(s, d)))
register("top_tokens", with_tc("SELECT * FROM tc ORDER BY count DESC, token LIMIT 25", "words", "words"))(lambda s, d: A.top_tokens(A.token_counts(B.words(s, d))))
register("rarest_tokens", with_tc("SELECT * FROM tc ORDER BY count, token LIMIT 25", "words", "words"))(lambda s, d: A.rarest_tokens(A.token_counts(B.words(s, d))))
register("entropy", with_tc("SELECT round(-sum(count / t * log2(count / t)), 6) AS entropy FROM tc, (SELECT sum(count) AS t FROM tc)", "words", "words"))(
    lambda s, d: A.entropy(A.token_counts(B.words(s, d))))
register("class_frequency", with_tc(f"SELECT c.token_class, token, count FROM tc JOIN (VALUES {LEX.classes_values()}) c(token_class, token) USING (token)", "seqt", "emit"))(
    lambda s, d: A.class_frequency(A.token_counts(emitted(s, d))))
LEN = """SELECT count(*) AS records, CAST(sum(len(tokens)) AS BIGINT) AS total_tokens, round(avg(len(tokens)), 6) AS avg_token_length, CAST(max(len(tokens)) AS BIGINT) AS max_token_length,
  round(avg(len(list_filter(tokens, lambda t: t = 'STEP')) / len(tokens)), 6) AS avg_step_density FROM {0} WHERE len(tokens) > 0"""
register("length_stats", sql(LEN.format("dirty"), "dirty"))(lambda s, d: A.length_stats(B.dirty(s, d)))
register("step_density", sql("SELECT level_id, round(len(list_filter(tokens, lambda t: t = 'STEP')) / len(tokens), 6) AS density FROM seqt", "emit"))(
    lambda s, d: emitted(s, d).select("level_id", F.round(A.step_share("tokens"), 6).alias("density")))
register("difficulty_counts", sql("SELECT difficulty, count(*) AS count FROM lvl GROUP BY 1", "lvl"))(lambda s, d: A.difficulty_counts(B.levels(s, d)))
register("rejection_counts", sql("SELECT reason, count(*) AS count FROM stats WHERE reason <> '' GROUP BY 1", "stats"))(lambda s, d: A.rejection_counts(stats(s, d)))
register("unknown_rate", sql("SELECT CAST(sum(object_count_raw) AS BIGINT) AS total_raw_objects, CAST(sum(unknown_object_count) AS BIGINT) AS total_unknown_objects, round(sum(unknown_object_count) / sum(object_count_raw), 6) AS unknown_object_rate FROM ostat", "ostat"))(
    lambda s, d: A.unknown_rate(O.object_stats(B.objects(s, d))))
register("unknown_ids_merged", sql("SELECT object_id, CAST(sum(count) AS BIGINT) AS count FROM unk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25", "unk"))(
    lambda s, d: A.unknown_ids_merged(O.object_stats(B.objects(s, d))))
register("unknown_ids_exact", sql("SELECT object_id, count(*) AS count FROM cls WHERE object_class = 'unknown' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50", "cls"))(
    lambda s, d: A.unknown_ids_exact(O.classify_objects(B.objects(s, d)), 50))
register("source_diversity", sql("SELECT count(DISTINCT nullif(source, '')) AS source_diversity FROM lvl", "lvl"))(lambda s, d: A.source_diversity(B.levels(s, d)))
register("diversity", sql("SELECT level_id, round(len(list_distinct(tokens)) / greatest(len(tokens), 1), 6) AS diversity FROM words", "words"))(
    lambda s, d: B.words(s, d).select("level_id", F.round(Q.diversity("tokens"), 6).alias("diversity")))
register("grammar_validity", sql("SELECT round(avg(CASE WHEN bad THEN 0 ELSE 1 END), 6) AS grammar_validity FROM (SELECT level_id, level_id IN (SELECT level_id FROM derr) AS bad FROM dirty WHERE len(tokens) > 0)", "dgram"))(
    lambda s, d: A.grammar_validity(B.dirty(s, d)))
VOC = """seen AS (SELECT t AS token, count(*) AS count, min(level_id * 1000000 + pos) AS first FROM (SELECT level_id, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS pos FROM {0}) GROUP BY 1),
 base AS (SELECT CAST(i - 1 AS BIGINT) AS token_id, {1}[i] AS token FROM range(1, {2}) r(i)),
 voc AS (SELECT token_id, token, coalesce(count, 0) AS count FROM base LEFT JOIN seen USING (token) UNION ALL
   SELECT {2} - 2 + row_number() OVER (ORDER BY first), token, count FROM seen WHERE token NOT IN (SELECT token FROM base))"""
voc = lambda src: VOC.format(src, VOCAB, len(LEX.base_vocabulary) + 1)
register("vocab", sql("", "words").rstrip() + ", " + voc("words") + " SELECT * FROM voc")(lambda s, d: V.build_vocabulary(B.words(s, d), "level_id"))
register("vocab_total", sql("", "words").rstrip() + ", " + voc("words") + " SELECT CAST(sum(count) AS BIGINT) AS token_total FROM voc")(
    lambda s, d: A.vocab_total(A.token_counts(B.words(s, d))))


def merged_vocab(s: SparkSession, d: str) -> DataFrame:
    """English documents build the vocabulary, all others are the batch merged into it."""
    docs = B.words(s, d).join(B.table(s, d, "documents").selectExpr("doc_id AS level_id", "lang"), "level_id")
    return V.merge_vocabulary(V.build_vocabulary(docs.where("lang = 'en'"), "level_id"), docs.where("lang <> 'en'"), "level_id")


register("vocab_merge", sql("", "words").rstrip() + ", w2 AS (SELECT w.*, lang FROM words w JOIN documents ON doc_id = level_id), wen AS (SELECT * FROM w2 WHERE lang = 'en'), " + voc("wen") + """,
 batch AS (SELECT t AS token, count(*) AS count, min(level_id * 1000000 + pos) AS first FROM (SELECT level_id, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS pos FROM w2 WHERE lang <> 'en') GROUP BY 1)
 SELECT token_id, token, voc.count + coalesce(batch.count, 0) AS count FROM voc LEFT JOIN batch USING (token) UNION ALL
 SELECT (SELECT max(token_id) FROM voc) + row_number() OVER (ORDER BY first), token, count FROM batch WHERE token NOT IN (SELECT token FROM voc)""")(merged_vocab)
register("token_ids", sql("", "dirty").rstrip() + f", base AS (SELECT CAST(i - 1 AS BIGINT) AS token_id, {VOCAB}[i] AS token FROM range(1, {len(LEX.base_vocabulary) + 1}) r(i))"
         " SELECT level_id, CAST(pos AS BIGINT) AS pos, token, coalesce(token_id, 1) AS token_id FROM (SELECT level_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM dirty) LEFT JOIN (SELECT * FROM base WHERE token_id % 9 <> 8) USING (token)")(
    lambda s, d: V.token_ids(E.token_rows(B.dirty(s, d)).withColumn("pos", F.col("pos").cast("bigint")),
                             LEX.vocabulary(s).where("token_id % 9 <> 8").withColumn("count", F.lit(1).cast("bigint"))))
register("id_union", "SELECT o_orderkey AS level_id FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")(
    lambda s, d: V.id_union(B.table(s, d, "orders").where("o_orderstatus = 'F'").selectExpr("o_orderkey AS level_id"),
                            B.table(s, d, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS level_id")))
register("unknown_tokens", with_tc(f"SELECT token, count FROM tc WHERE token NOT IN ({q(KNOWN)})", "dirty", "dirty"))(
    lambda s, d: V.unknown_token_report(A.token_counts(B.dirty(s, d)), LEX.vocabulary(s).where("token_id % 9 <> 8")))


@register("dataset_report", sql("", "stats").rstrip() + ", acc AS (SELECT * FROM stats WHERE reason = ''), " + TC.format("acc") + f"""
 SELECT x.*, (SELECT count(*) FROM stats) AS levels_processed, (SELECT count(*) FROM stats WHERE reason <> '') AS levels_rejected,
  (SELECT CAST(sum(object_count_raw) AS BIGINT) FROM stats) AS total_raw_objects, (SELECT CAST(sum(unknown_object_count) AS BIGINT) FROM stats) AS total_unknown_objects,
  (SELECT round(sum(unknown_object_count) / sum(object_count_raw), 6) FROM stats) AS unknown_object_rate,
  (SELECT round(-sum(count / t * log2(count / t)), 6) FROM tc, (SELECT sum(count) AS t FROM tc)) AS token_entropy, (SELECT count(*) FROM tc) AS vocab_observed, CAST(0 AS BIGINT) AS unknown_token_count,
  (SELECT string_agg(difficulty || '=' || n, ' ' ORDER BY difficulty) FROM (SELECT difficulty, count(*) AS n FROM acc GROUP BY 1)) AS difficulty_counts,
  (SELECT coalesce(string_agg(reason || '=' || n, ' ' ORDER BY reason), '') FROM (SELECT reason, count(*) AS n FROM stats WHERE reason <> '' GROUP BY 1)) AS rejection_reasons,
  (SELECT string_agg(token || '=' || count, ' ' ORDER BY count DESC, token) FROM (SELECT * FROM tc ORDER BY count DESC, token LIMIT 25)) AS top_tokens,
  (SELECT string_agg(token || '=' || count, ' ' ORDER BY count, token) FROM (SELECT * FROM tc ORDER BY count, token LIMIT 25)) AS rarest_tokens,
  (SELECT string_agg(object_id || '=' || c, ' ' ORDER BY c DESC, object_id) FROM (SELECT object_id, sum(count) AS c FROM unk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25)) AS top_unknown_object_ids,
  (SELECT string_agg(token || '=' || count, ' ' ORDER BY count DESC, token) FROM tc WHERE token IN ({MECH})) AS object_frequency,
  (SELECT coalesce(string_agg(token || '=' || count, ' ' ORDER BY count DESC, token), '') FROM tc WHERE token IN ({q(LEX.portals)})) AS portal_frequency,
  (SELECT coalesce(string_agg(token || '=' || count, ' ' ORDER BY count DESC, token), '') FROM tc WHERE token IN ({q(LEX.orbs)})) AS orb_frequency
 FROM ({LEN.format('acc')}) x""")
def dataset_report(s: SparkSession, d: str) -> DataFrame:
    st = stage(stats(s, d))
    out = A.dataset_report(st.where("accepted"), st)
    for name, key in (("difficulty_counts", "key"), ("rejection_reasons", "key")):
        out = out.withColumn(name, F.expr(f"array_join(transform(map_entries({name}), e -> concat(e.key, '=', e.value)), ' ')"))
    for name in ("top_tokens", "rarest_tokens", "object_frequency", "portal_frequency", "orb_frequency", "top_unknown_object_ids"):
        key = "object_id" if name.startswith("top_unknown") else "token"
        out = out.withColumn(name, F.expr(f"array_join(transform({name}, e -> concat(e.{key}, '=', e.count)), ' ')"))
    return out


# -- quality ------------------------------------------------------------------
LANE_NEXT = f"""CASE WHEN o.token IN ({SOLID}) THEN CASE WHEN o.y_lane <= a.lane AND o.y_lane + 1 >= a.lane THEN greatest(a.lane, o.y_lane + 1)
   WHEN o.y_lane < a.lane THEN greatest(1, o.y_lane + 1) ELSE a.lane END
   WHEN o.token IN ({q(LEX.orbs)}) THEN greatest(greatest(1, a.lane - 2), least(least(15, a.lane + 2), o.y_lane))
   WHEN o.token IN ({q(LEX.pads)}) THEN greatest(1, least(15, o.y_lane + 1)) ELSE a.lane END"""


def quality_sql(source: str, p: str) -> str:
    """Path rows by a recursive walk, then metrics and the score."""
    return f""", {p}cell AS (SELECT level_id, x_step + unnest(range(0, CASE WHEN token IN ({SOLID}) THEN greatest(1, width) ELSE 1 END)) AS x, y_lane FROM {p}obj),
 {p}dup AS (SELECT level_id, sum(c - 1) AS dup FROM (SELECT level_id, x, y_lane, count(*) AS c FROM {p}cell GROUP BY ALL) GROUP BY 1),
 {p}load AS (SELECT level_id, max(c) AS load, sum(c) AS n FROM (SELECT level_id, x_step, count(*) AS c FROM {p}obj GROUP BY ALL) GROUP BY 1),
 {p}ctl AS (SELECT level_id, sequence, x_step, CASE WHEN token LIKE 'PORTAL%' THEN 'p' WHEN token LIKE 'GRAVITY%' THEN 'g' WHEN token LIKE 'SPEED%' THEN 's' END AS cat FROM {p}obj),
 {p}spam AS (SELECT level_id, count(*) AS spam FROM (SELECT level_id, x_step - lag(x_step) OVER (PARTITION BY level_id, cat ORDER BY sequence) AS gap FROM {p}ctl WHERE cat IS NOT NULL) WHERE gap < 8 GROUP BY 1),
 {p}walk AS (WITH RECURSIVE w AS (
   SELECT level_id, CAST(-1 AS BIGINT) AS sequence, CAST(NULL AS BIGINT) AS x_step, CAST(1 AS BIGINT) AS lane, CAST(NULL AS BIGINT) AS lv, 0 AS hit FROM {source}
   UNION ALL SELECT level_id, sequence, CAST(x_step AS BIGINT), CAST(nl AS BIGINT), CAST(CASE WHEN px = x_step THEN round_even((pat + nl) / 2e0, 0) ELSE nl END AS BIGINT), hit FROM (
     SELECT o.level_id, o.sequence, o.x_step, a.x_step AS px, a.lv AS pat, {LANE_NEXT} AS nl, CASE WHEN o.token = 'BLOCK' AND o.y_lane > 0 AND o.y_lane IN (a.lane, a.lane + 1) THEN 1 ELSE 0 END AS hit
     FROM w a JOIN {p}obj o ON o.level_id = a.level_id AND o.sequence = a.sequence + 1)) SELECT * FROM w WHERE sequence >= 0),
 {p}path AS (SELECT level_id, x_step AS step, arg_max(lv, sequence) AS lane FROM {p}walk GROUP BY 1, 2),
 {p}pm AS (SELECT level_id, count(*) FILTER (nx - step > 6) AS gaps, count(*) FILTER (abs(nl - lane) > 4) AS jumps FROM (
   SELECT *, lead(step) OVER w AS nx, lead(lane) OVER w AS nl FROM {p}path WINDOW w AS (PARTITION BY level_id ORDER BY step)) GROUP BY 1),
 {p}hit AS (SELECT level_id, sum(hit) AS hits FROM {p}walk GROUP BY 1),
 {p}rep AS ({REP.format(p)}),
 {p}e1 AS (SELECT level_id, count(*) AS ne FROM {p}err GROUP BY 1),
 {p}m AS (SELECT s.level_id, len(tokens) AS nt, len(list_filter(tokens, lambda t: t = 'STEP')) AS steps, len(list_distinct(tokens)) / greatest(len(tokens), 1) AS divers,
   len(list_filter(tokens, lambda t: t IN ({MECH}))) AS mechs, len(list_filter(tokens, lambda t: t IN ({q(LEX.orbs)}))) AS orbs, len(list_filter(tokens, lambda t: t IN ({q(LEX.portals)}))) AS portals,
   coalesce(ne, 0) AS ne, coalesce(dup, 0) AS dup, coalesce(load, 0) AS load, coalesce(n, 0) AS n, coalesce(spam, 0) AS spam, coalesce(gaps, 0) AS gaps, coalesce(jumps, 0) AS jumps, coalesce(hits, 0) AS hits,
   coalesce(max_repetition, 0) AS rep FROM {source} s LEFT JOIN {p}e1 USING (level_id) LEFT JOIN {p}dup USING (level_id) LEFT JOIN {p}load USING (level_id) LEFT JOIN {p}spam USING (level_id)
   LEFT JOIN {p}pm USING (level_id) LEFT JOIN {p}hit USING (level_id) LEFT JOIN {p}rep USING (level_id)),
 {p}q AS (SELECT *, round(greatest(0, 1e2 - 18e0 * ne - 5e0 * dup - 6e0 * greatest(0, load - 3) - 8e0 * spam - 4e0 * gaps - 7e0 * jumps - 9e0 * hits
   + 24e0 * (1 - least(1, abs(n - greatest(8, least(160, steps))) / CAST(greatest(8, least(160, steps)) AS DOUBLE))) + 30e0 * least(divers, 45e-2) + 18e0 * least(mechs / greatest(nt, 1), 45e-2)
   + 10e0 * least(steps / greatest(nt, 1), 45e-2) + 8e-1 * least(orbs, 12) + 8e-1 * least(portals, 4) - CASE WHEN n = 0 THEN 8e1 ELSE 0 END - CASE WHEN steps < 12 THEN 3e1 ELSE 0 END), 6) AS score FROM {p}m),
 {p}quality AS (SELECT level_id, score, ne = 0 AND n > 0 AS valid, CAST(n AS BIGINT) AS object_count, CAST(steps AS BIGINT) AS step_count, CAST(dup AS BIGINT) AS duplicate_positions, CAST(load AS BIGINT) AS max_objects_per_step,
   CAST(spam AS BIGINT) AS control_spam, CAST(gaps AS BIGINT) AS path_gaps, CAST(jumps AS BIGINT) AS path_jumps, CAST(hits AS BIGINT) AS path_obstructions, round(divers, 6) AS diversity, CAST(rep AS BIGINT) AS max_repetition FROM {p}q)"""


DQ, SQ = sql("", "dgram").rstrip() + quality_sql("dirty", "d"), sql("", "sgram").rstrip() + quality_sql("seqt", "s")
objs = lambda seqs: G.with_objects(seqs)
register("dup_positions", DQ + " SELECT level_id, duplicate_positions FROM dquality")(lambda s, d: objs(B.dirty(s, d)).select("level_id", Q.duplicate_positions("objects").alias("duplicate_positions")))
register("step_load", DQ + " SELECT level_id, max_objects_per_step FROM dquality")(lambda s, d: objs(B.dirty(s, d)).select("level_id", Q.max_objects_per_step("objects").alias("max_objects_per_step")))
register("control_spam", DQ + " SELECT level_id, control_spam FROM dquality")(lambda s, d: objs(B.dirty(s, d)).select("level_id", Q.control_spam("objects").alias("control_spam")))
register("lane_path", SQ + " SELECT level_id, string_agg(step || ':' || lane, ' ' ORDER BY step) AS path FROM spath GROUP BY 1 UNION ALL SELECT level_id, '0:1' FROM seqs WHERE level_id NOT IN (SELECT level_id FROM sobj)")(
    lambda s, d: objs(emitted(s, d)).withColumn("p", Q.lane_path("objects")).select("level_id", F.expr("array_join(transform(p, e -> concat(e.step, ':', e.lane)), ' ')").alias("path")))
register("path_metrics", DQ + " SELECT level_id, path_gaps, path_jumps, path_obstructions FROM dquality")(
    lambda s, d: objs(B.dirty(s, d)).withColumn("p", Q.path_metrics("objects")).select("level_id", F.col("p.gaps").alias("path_gaps"), F.col("p.jumps").alias("path_jumps"), F.col("p.hits").alias("path_obstructions")))
register("quality", SQ + " SELECT * FROM squality")(lambda s, d: Q.quality_report(emitted(s, d)).drop("errors"))
register("quality_dirty", DQ + " SELECT * FROM dquality")(lambda s, d: Q.quality_report(B.dirty(s, d)).drop("errors"))
register("collapse_flag", SQ + " SELECT level_id, diversity < 18e-2 OR max_repetition > 16 OR score < 8e1 OR path_obstructions > 0 OR control_spam > 2 AS collapsed FROM squality")(
    lambda s, d: Q.collapse_flag(Q.quality_report(emitted(s, d))).select("level_id", "collapsed"))
register("rank_candidates", SQ + """ SELECT grp, level_id, score, valid FROM (SELECT level_id % 10 AS grp, *, row_number() OVER (PARTITION BY level_id % 10
   ORDER BY valid DESC, score + max_repetition * 1e0 * 55e-2 DESC, object_count DESC, level_id) AS r FROM squality) WHERE r = 1""")(
    lambda s, d: Q.rank_candidates(Q.quality_report(emitted(s, d)).drop("errors").withColumn("grp", F.col("level_id") % 10).withColumn("flow_score_total", F.col("max_repetition").cast("double"))
                                   .withColumn("sync_score", F.col("object_count")), "grp", "level_id").select("grp", "level_id", "score", "valid"))
