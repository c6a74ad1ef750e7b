"""Reference SQL fragments for checking registered queries in another engine.

Each fragment is a common table expression over the given tables; a query's
SQL names the fragments it needs.
"""
from __future__ import annotations

from lanestride.dims import DEFAULT as LEX
from lanestride.plans.bindings import EPOCH_US, HOUR_US, LABELS, ORDER_LINES, SOURCES


def q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)


SOLID, MECH, LANES, WIDTHS, DIFFS = q(LEX.solids), q(LEX.mechanics), q(LEX.lane_tokens), q(LEX.width_tokens), q(LEX.difficulties)
VOCAB = "[" + q(LEX.base_vocabulary) + "]"
X_HOURS = f"(epoch_us(ts) - {EPOCH_US}) / {HOUR_US / 1e9}e9"


def emit_sql(cap: int) -> str:
    return f"""
 ev AS (SELECT *, CASE WHEN token IN ({SOLID}) THEN 3 ELSE 2 END AS len,
   x_step - coalesce(lag(x_step) OVER w, 0) AS gap FROM rruns WINDOW w AS (PARTITION BY level_id ORDER BY x_step, rank, y_lane, object_id)),
 ev2 AS (SELECT *, 3 + sum(gap + len) OVER (PARTITION BY level_id ORDER BY x_step, rank, y_lane, object_id ROWS UNBOUNDED PRECEDING) - len AS st FROM ev),
 bodies AS (SELECT level_id, string_agg(CASE WHEN st <= {cap} THEN repeat(' STEP', CAST(gap AS INT)) || ' ' || token || ' Y' || y_lane ||
     CASE WHEN len = 3 THEN ' WIDTH_' || width ELSE '' END ELSE '' END, '' ORDER BY x_step, rank, y_lane, object_id) AS body, bool_or(st + len > {cap}) AS over FROM ev2 GROUP BY level_id),
 seqs AS (SELECT l.level_id, l.difficulty, l.source, 'START ' || difftok || ' ALIGN_UNKNOWN' || coalesce(body, '') ||
     CASE WHEN coalesce(over, false) THEN '' ELSE ' STEP END' END AS txt, coalesce(over, false) AS over FROM lvl l LEFT JOIN bodies USING (level_id)),
 seqt AS (SELECT *, string_split(txt, ' ') AS tokens FROM seqs)"""


def grammar_sql(source: str, prefix: str) -> str:
    """Long rows, error rows and object rows of the sequences in CTE ``source``."""
    p = prefix
    return f"""
 {p}k AS (SELECT level_id, len(tokens) AS n, tokens, unnest(tokens) AS t, generate_subscripts(tokens, 1) - 1 AS pos FROM {source}),
 {p}a AS (SELECT *, CASE WHEN t = 'STEP' THEN '+' WHEN t IN ({LANES}) THEN 'Y' WHEN t IN ({SOLID}) THEN 'S' WHEN t IN ({MECH}) THEN 'M'
    WHEN t IN ({WIDTHS}) THEN 'W' WHEN t = 'END' THEN 'E' WHEN t = 'START' THEN 'B' WHEN t = 'ALIGN_UNKNOWN' THEN 'A'
    WHEN t IN ({DIFFS}) THEN 'D' ELSE '?' END AS k,
    1 + CASE WHEN tokens[2] IN ({DIFFS}) THEN 1 + CASE WHEN coalesce(tokens[3], '') = 'ALIGN_UNKNOWN' THEN 1 ELSE 0 END
             WHEN tokens[2] = 'ALIGN_UNKNOWN' THEN 1 ELSE 0 END AS p FROM {p}k),
 {p}b AS (SELECT *, min(CASE WHEN k = 'E' AND pos >= p THEN pos END) OVER (PARTITION BY level_id) AS e FROM {p}a),
 {p}c AS (SELECT *, coalesce(lead(k, 1) OVER w, '-') AS k1, coalesce(lead(k, 2) OVER w, '-') AS k2, lead(t, 1) OVER w AS t1, lead(t, 2) OVER w AS t2,
    CASE WHEN pos - 1 >= p THEN lag(k, 1) OVER w ELSE '-' END AS g1, CASE WHEN pos - 2 >= p THEN lag(k, 2) OVER w ELSE '-' END AS g2,
    count(CASE WHEN k = '+' AND pos >= p THEN 1 END) OVER (PARTITION BY level_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS steps
    FROM {p}b WINDOW w AS (PARTITION BY level_id ORDER BY pos)),
 {p}in AS (SELECT * FROM {p}c WHERE pos >= p AND (e IS NULL OR pos < e)),
 {p}err AS (
   SELECT level_id, -2 AS pos, 'missing_start' AS err FROM {p}a WHERE pos = 0 AND k <> 'B'
   UNION ALL SELECT level_id, -1, 'missing_end' FROM {p}a WHERE pos = n - 1 AND k <> 'E'
   UNION ALL SELECT level_id, 1000000000, 'tokens_after_end' FROM {p}b WHERE pos = 0 AND e < n - 1
   UNION ALL SELECT level_id, pos, err FROM (SELECT level_id, pos, CASE
     WHEN k IN ('S', 'M') AND k1 <> 'Y' THEN 'missing_y_after:' || t
     WHEN k = 'S' AND k2 <> 'W' THEN 'missing_width_after:' || t
     WHEN k = 'M' AND k2 = 'W' THEN 'unexpected_width_after:' || t
     WHEN k = 'Y' AND g1 NOT IN ('S', 'M') THEN 'orphan_y_token:' || t
     WHEN k = 'W' AND NOT (g1 = 'Y' AND g2 IN ('S', 'M')) THEN 'orphan_width_token:' || t
     WHEN k = 'B' THEN 'unexpected_start' WHEN k IN ('D', 'A') THEN 'unexpected_prefix_token:' || t
     WHEN k = '?' THEN 'unknown_token:' || t END AS err FROM {p}in) WHERE err IS NOT NULL),
 {p}obj AS (SELECT level_id, row_number() OVER (PARTITION BY level_id ORDER BY pos) - 1 AS sequence, t AS token, steps AS x_step,
    CAST(substr(t1, 2) AS BIGINT) AS y_lane, CASE WHEN k = 'S' THEN CAST(substr(t2, 7) AS BIGINT) ELSE 1 END AS width
    FROM {p}in WHERE k IN ('S', 'M') AND k1 = 'Y' AND (k = 'M' OR k2 = 'W'))"""


_label = lambda names, n: f"[{q(names)}][CAST(user_id % {n} AS INT) + 1]"
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "ol": ((), f"ol AS (SELECT {ORDER_LINES} FROM orders)"),
    "omap": ((), f"omap(object_id, token) AS (VALUES {LEX.object_map_values()})"),
    "mech": ((), f"mech(token, rank, is_solid) AS (VALUES {LEX.mechanics_values()})"),
    "obj": ((), f"obj AS (SELECT user_id AS level_id, event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS object_id, {X_HOURS} AS x, value AS y FROM events)"),
    "lvl": ((), f"""lvl AS (SELECT *, CASE WHEN 'DIFF_' || nd IN ({DIFFS}) THEN 'DIFF_' || nd ELSE 'DIFF_NA' END AS difftok FROM (
        SELECT user_id AS level_id, {_label(LABELS, 9)} AS difficulty, {_label(SOURCES, 5)} AS source,
        regexp_replace(replace(upper(trim({_label(LABELS, 9)})), ' ', '_'), '_DEMON$', '') AS nd FROM (SELECT DISTINCT user_id FROM events)))"""),
    "mapped": (("obj", "omap"), "mapped AS (SELECT o.*, token FROM obj o JOIN omap USING (object_id))"),
    "org": (("mapped",), """org AS (SELECT level_id, n, x_origin, y AS y_origin FROM (SELECT level_id, y, row_number() OVER (PARTITION BY level_id ORDER BY y) - 1 AS rn,
        count(*) OVER (PARTITION BY level_id) AS n, min(x) OVER (PARTITION BY level_id) AS x_origin FROM mapped) WHERE rn = round_even((n - 1) * 5e-2, 0))"""),
    "quant": (("org",), """quant AS (SELECT m.*, CAST(greatest(0, round_even((x - x_origin) / 3e1, 0)) AS BIGINT) AS x_step,
        CAST(greatest(0, least(15, round_even((y - y_origin) / 3e1, 0))) AS BIGINT) AS y_lane FROM mapped m JOIN org USING (level_id))"""),
    "cells": (("quant",), """cells AS (SELECT level_id, token, y_lane, x_step, arg_min(object_id, seq) AS object_id, arg_min(x, seq) AS x, arg_min(y, seq) AS y
        FROM quant GROUP BY ALL)"""),
    "runs": (("cells", "mech"), """runs AS (SELECT level_id, arg_min(object_id, x_step) AS object_id, token, arg_min(x, x_step) AS x, arg_min(y, x_step) AS y,
        min(x_step) AS x_step, y_lane, CAST(least(16, count(*)) AS BIGINT) AS width FROM (
          SELECT c.*, CASE WHEN is_solid THEN x_step - row_number() OVER (PARTITION BY level_id, token, y_lane ORDER BY x_step) ELSE 1000000 + x_step END AS grp
          FROM cells c JOIN mech USING (token)) GROUP BY level_id, token, y_lane, grp)"""),
    "rruns": (("runs",), "rruns AS (SELECT r.*, rank FROM runs r JOIN mech USING (token))"),
    "emit": (("rruns", "lvl"), emit_sql(12_000)),
    "emit60": (("rruns", "lvl"), emit_sql(60)),
    "cls": (("obj", "omap"), f"""cls AS (SELECT o.*, token, CASE WHEN token IS NOT NULL THEN 'mapped' WHEN object_id IN ({q(LEX.ignored_ids)}) THEN 'ignored'
        ELSE 'unknown' END AS object_class FROM obj o LEFT JOIN omap USING (object_id))"""),
    "unk": (("cls",), """unk AS (SELECT level_id, object_id, c AS count FROM (SELECT level_id, object_id, count(*) AS c,
        row_number() OVER (PARTITION BY level_id ORDER BY count(*) DESC, object_id) AS r FROM cls WHERE object_class = 'unknown' GROUP BY 1, 2) WHERE r <= 20)"""),
    "ostat": (("unk",), """ostat AS (SELECT level_id, count(*) AS object_count_raw, count(*) FILTER (object_class = 'mapped') AS gameplay_source_object_count,
        count(*) FILTER (object_class = 'ignored') AS ignored_object_count, count(*) FILTER (object_class = 'unknown') AS unknown_object_count,
        round(count(*) FILTER (object_class = 'unknown') / count(*), 6) AS unknown_object_ratio FROM cls GROUP BY 1)"""),
    "gcount": (("runs",), "gcount AS (SELECT level_id, count(*) AS object_count_gameplay, count(DISTINCT x_step) AS unique_x_steps FROM runs GROUP BY 1)"),
    "stats": (("emit", "ostat", "gcount"), """stats AS (SELECT s.level_id, s.difficulty, s.source, s.tokens, object_count_raw, coalesce(object_count_gameplay, 0) AS object_count_gameplay,
        gameplay_source_object_count, ignored_object_count, unknown_object_count, unknown_object_ratio, CAST(len(tokens) AS BIGINT) AS token_count, coalesce(unique_x_steps, 0) AS unique_x_steps,
        CASE WHEN coalesce(object_count_gameplay, 0) < 20 THEN 'too_few_gameplay_objects' WHEN len(tokens) < 50 THEN 'too_few_tokens' WHEN over THEN 'missing_start_or_end'
        WHEN unknown_object_ratio > 995e-3 THEN 'unknown_object_ratio_too_high' WHEN coalesce(unique_x_steps, 0) <= 1 THEN 'all_objects_one_timestep' ELSE '' END AS reason
        FROM seqt s JOIN ostat USING (level_id) LEFT JOIN gcount USING (level_id))"""),
    "dirty": ((), f"""dirty AS (SELECT doc_id AS level_id, source, (CASE WHEN doc_id % 3 < 2 THEN ['START', 'DIFF_HARD', 'ALIGN_UNKNOWN'] ELSE [] END)
        || [{VOCAB}[CAST((unicode(w) * 7 + length(w)) % {len(LEX.base_vocabulary)} AS INT) + 1] for w in string_split(text, ' ') if w <> '']
        || (CASE WHEN doc_id % 3 = 0 THEN ['END'] ELSE [] END) AS tokens FROM documents)"""),
    "words": ((), "words AS (SELECT doc_id AS level_id, source, [w for w in string_split(text, ' ') if w <> ''] AS tokens FROM documents)"),
    "dgram": (("dirty",), grammar_sql("dirty", "d")),
    "sgram": (("emit",), grammar_sql("seqt", "s")),
    "energy": ((), f"""energy AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY cell) - 1 AS idx, (row_number() OVER (PARTITION BY series ORDER BY cell) - 1) * 1e-1 AS t, value FROM (
        SELECT user_id % 5 AS series, floor({X_HOURS}) AS cell, sqrt(avg(value * value)) AS value FROM events GROUP BY 1, 2))"""),
    "norm": (("energy",), """norm AS (SELECT series, idx, t, (value - min(value) OVER w) / greatest(max(value) OVER w - min(value) OVER w, 1e-9) AS value
        FROM energy WINDOW w AS (PARTITION BY series))"""),
    "smooth": (("norm",), """smooth AS (SELECT series, idx, t, CASE WHEN count(*) OVER (PARTITION BY series) < 3 THEN value
        ELSE avg(value) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) END AS value FROM norm)"""),
    "cand": (("smooth",), """rise AS (SELECT series, idx, t, greatest(0, value - lag(value) OVER (PARTITION BY series ORDER BY idx)) AS delta FROM smooth),
        cand AS (SELECT series, idx, t, delta FROM (SELECT *, count(*) OVER w AS n, avg(delta) OVER w AS m, stddev_pop(delta) OVER w AS d FROM rise WHERE idx > 0 WINDOW w AS (PARTITION BY series))
        WHERE n >= 3 AND delta >= greatest(8e-2, m + 115e-2 * d))"""),
}


def gap_sql(source: str, keys: str, place: str, gap: str, out: str) -> str:
    """Greedy keep-first by a recursive walk: next kept = first position at least ``gap`` later."""
    k = [c.strip() for c in keys.split(",")]
    same = " AND ".join(f"n.{c} = w.{c}" for c in k)
    wk = ", ".join(f"w.{c}" for c in k)
    return f"""{out} AS (WITH RECURSIVE w AS (
        SELECT {keys}, min({place}) AS {place} FROM {source} GROUP BY {keys}
        UNION ALL SELECT {wk}, (SELECT min(n.{place}) FROM {source} n WHERE {same} AND n.{place} - w.{place} >= {gap}) AS {place} FROM w
          WHERE w.{place} IS NOT NULL) SELECT * FROM w WHERE {place} IS NOT NULL)"""


CTE["onset"] = (("cand",), gap_sql("cand", "series", "t", "16e-2", "onset"))
CTE["gaps"] = (("onset",), "gaps AS (SELECT * FROM (SELECT series, t, t - lag(t) OVER (PARTITION BY series ORDER BY t) AS gap FROM onset) WHERE gap IS NOT NULL)")
CTE["lags"] = (("smooth",), """lags AS (SELECT a.series, l.lag, sum(a.value * b.value) / count(*) AS score FROM smooth a, (SELECT unnest(range(2, 11)) AS lag) l
        JOIN smooth b ON a.series = b.series AND a.idx = b.idx + l.lag GROUP BY 1, 2)""")
CTE["best"] = (("lags",), """best AS (SELECT s.series, s.n, CASE WHEN n >= 20 THEN lag END AS lag, CASE WHEN n >= 20 THEN score END AS score, CASE WHEN n >= 20 THEN 60 / (lag * 1e-1) ELSE 12e1 END AS bpm FROM
        (SELECT series, count(*) AS n FROM smooth GROUP BY 1) s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY series ORDER BY score DESC, lag) AS r FROM lags) x ON x.series = s.series AND r = 1)""")
CTE["tempo"] = (("best", "gaps"), """tempo AS (SELECT series, CAST(round_even(greatest(80, least(210, CASE WHEN b < 80 THEN b * power(2, ceil(log2(80 / b))) WHEN b > 210 THEN b / power(2, ceil(log2(b / 210))) ELSE b END)), 0) AS BIGINT) AS bpm
        FROM (SELECT best.series, coalesce(60 / g, bpm) AS b FROM best LEFT JOIN (SELECT series, quantile_cont(gap, 5e-1) AS g FROM gaps WHERE gap >= 24e-2 AND gap <= 12e-1 GROUP BY 1) USING (series)))""")
CTE["dur"] = (("energy",), "dur AS (SELECT series, (max(idx) + 1) * 1e-1 AS duration, count(*) AS points FROM energy GROUP BY 1)")
CTE["beat"] = (("tempo", "onset", "dur"), """beat0 AS (SELECT series, duration, 6e1 / bpm AS i, coalesce(f, 0) AS f FROM tempo JOIN dur USING (series) LEFT JOIN (SELECT series, min(t) AS f FROM onset GROUP BY 1) USING (series)),
        beat1 AS (SELECT *, CASE WHEN f > i THEN f - (ceil(f / i) - 1) * i ELSE f END AS p FROM beat0),
        beat AS (SELECT series, k AS beat, p + k * i AS t FROM (SELECT *, unnest(range(0, 1 + CAST(floor((duration + i - p) / i) AS BIGINT))) AS k FROM beat1))""")


def sql(final: str, *names: str) -> str:
    """A full statement: the fragments ``names`` need, in order, then ``final``."""
    done: list[str] = []

    def need(name: str) -> None:
        for dep in CTE[name][0]:
            need(dep)
        if name not in done:
            done.append(name)

    for name in names:
        need(name)
    return ("WITH " + ",\n".join(CTE[n][1].strip() for n in done) + "\n" if done else "") + final
