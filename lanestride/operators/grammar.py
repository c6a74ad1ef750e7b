"""Sequence grammar: validation, reconstruction, audits.

Everything about one sequence is computed inside its row, on arrays: no
exchange, no window, and a record's size is the only bound involved.  The
grammar is local — whether a token is consumed or an error depends on at most
two tokens either side — so it is written as neighbour rules.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lanestride.dims import DEFAULT, Lexicon
from lanestride.functions.columns import sql_text, unnest
from lanestride.operators.spread import ordered_index

KEY = "level_id"
OBJECT_TYPE = "struct<token:string,x_step:bigint,y_lane:bigint,width:bigint>"


SOLID, MECH, LANE, WIDTH, STEP, DIFF, ALIGN, START, END, OTHER = 1, 2, 3, 4, 5, 6, 7, 8, 9, 0


def kind_sql(token: str, lexicon: Lexicon) -> str:
    """Token class as a small integer, the most frequent classes first."""
    plain = tuple(t for t in lexicon.mechanics if t not in lexicon.solids)
    text = lambda ts: ", ".join(sql_text(t) for t in ts)
    return (f"CASE WHEN {token} = {sql_text(lexicon.step)} THEN {STEP} "
            f"WHEN {token} IN ({text(lexicon.lane_tokens)}) THEN {LANE} "
            f"WHEN {token} IN ({text(lexicon.width_tokens)}) THEN {WIDTH} "
            f"WHEN {token} IN ({text(lexicon.solids)}) THEN {SOLID} "
            f"WHEN {token} IN ({text(plain)}) THEN {MECH} "
            f"WHEN {token} = {sql_text(lexicon.end)} THEN {END} "
            f"WHEN {token} = {sql_text(lexicon.start)} THEN {START} "
            f"WHEN {token} = {sql_text(lexicon.align)} THEN {ALIGN} "
            f"WHEN {token} IN ({text(lexicon.difficulties)}) THEN {DIFF} ELSE {OTHER} END")


def _bind(value: str, name: str, body: str) -> str:
    """SQL ``let name = value in body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def tagged(tokens: str, lexicon: Lexicon = DEFAULT) -> Column:
    """The sequence as ``(k kinds, p prefix length, e position of the first end mark or the size)``.

    Computed once per row; every rule below reads the integer kinds.
    """
    prefix = (f"1 + CASE WHEN get(k, 1) = {DIFF} THEN 1 + int(coalesce(get(k, 2) = {ALIGN}, false)) "
              f"ELSE int(coalesce(get(k, 1) = {ALIGN}, false)) END")
    rest = "slice(k, 1 + p, greatest(0, size(k) - p))"
    end = f"int(array_position({rest}, {END}))"
    parts = _bind(prefix, "p", f"named_struct('k', k, 'p', p, 'e', {_bind(end, 'f', 'CASE WHEN f > 0 THEN p + f - 1 ELSE size(k) END')})")
    return F.expr(_bind(f"transform({tokens}, t -> {kind_sql('t', lexicon)})", "k", parts))


def errors_of(tokens: str, tag: str) -> Column:
    """Ordered errors of a tagged sequence: start, end, by position, after-end.

    Neighbours before the body's first position do not count; those after the
    end mark never decide anything, since the end mark itself breaks a rule.
    """
    k = lambda d: f"coalesce(get({tag}.k, i + {d}), -1)"
    back = lambda d: f"CASE WHEN i - {d} >= {tag}.p THEN get({tag}.k, i - {d}) ELSE -1 END"
    name = f"get({tokens}, i)"
    error = (
        f"CASE x WHEN {STEP} THEN NULL "
        f"WHEN {LANE} THEN CASE WHEN {back(1)} IN ({SOLID}, {MECH}) THEN NULL ELSE concat('orphan_y_token:', {name}) END "
        f"WHEN {WIDTH} THEN CASE WHEN {back(1)} = {LANE} AND {back(2)} IN ({SOLID}, {MECH}) THEN NULL ELSE concat('orphan_width_token:', {name}) END "
        f"WHEN {SOLID} THEN CASE WHEN {k(1)} <> {LANE} THEN concat('missing_y_after:', {name}) "
        f"WHEN {k(2)} <> {WIDTH} THEN concat('missing_width_after:', {name}) END "
        f"WHEN {MECH} THEN CASE WHEN {k(1)} <> {LANE} THEN concat('missing_y_after:', {name}) "
        f"WHEN {k(2)} = {WIDTH} THEN concat('unexpected_width_after:', {name}) END "
        f"WHEN {START} THEN 'unexpected_start' "
        f"WHEN {OTHER} THEN concat('unknown_token:', {name}) ELSE concat('unexpected_prefix_token:', {name}) END")
    body = (f"filter(transform({tag}.k, (x, i) -> CASE WHEN i < {tag}.p OR i >= {tag}.e THEN NULL ELSE {error} END), m -> m IS NOT NULL)")
    return F.expr(
        f"CASE WHEN coalesce(size({tokens}), 0) <= 0 THEN array('empty_sequence') ELSE concat("
        f"CASE WHEN {tag}.k[0] <> {START} THEN array('missing_start') ELSE array() END, "
        f"CASE WHEN element_at({tag}.k, -1) <> {END} THEN array('missing_end') ELSE array() END, {body}, "
        f"CASE WHEN {tag}.e < size({tokens}) - 1 THEN array('tokens_after_end') ELSE array() END) END")


def objects_of(tokens: str, tag: str) -> Column:
    """Objects of a tagged sequence in order.

    The body is cut at its step marks; the index of a cut is the step of every
    object in it.  A rule never reaches over a step mark, so each piece is
    handled alone and the whole scan is linear.
    """
    item = (f"CASE WHEN x IN ({SOLID}, {MECH}) AND get({tag}.k, o + 1) = {LANE} AND (x = {MECH} OR get({tag}.k, o + 2) = {WIDTH}) "
            f"THEN CAST(struct(get({tokens}, o), c, bigint(substring(get({tokens}, o + 1), 2)), "
            f"CASE WHEN x = {SOLID} THEN bigint(substring(get({tokens}, o + 2), 7)) ELSE 1 END) AS {OBJECT_TYPE}) END")
    low = f"CASE WHEN c = 0 THEN {tag}.p ELSE m[c - 1] + 1 END"
    high = f"CASE WHEN c = size(m) THEN {tag}.e ELSE m[c] END"
    piece = (f"transform(slice({tag}.k, 1 + a, greatest(0, {high} - a)), (x, i) -> {_bind('a + i', 'o', item)})")
    found = f"filter({_bind(low, 'a', piece)}, o -> o IS NOT NULL)"
    marks = f"filter(transform({tag}.k, (x, i) -> CASE WHEN x = {STEP} AND i >= {tag}.p AND i < {tag}.e THEN i END), x -> x IS NOT NULL)"
    whole = _bind(marks, "m", f"flatten(transform(sequence(0, size(m)), c -> {found}))")
    return F.expr(f"CASE WHEN coalesce(size({tokens}), 0) <= 0 THEN CAST(array() AS array<{OBJECT_TYPE}>) ELSE {whole} END")


def with_objects(sequences: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Add ``kinds``, ``objects`` and ``errors`` arrays next to ``tokens``; the sequence is tagged once."""
    return (sequences.withColumn("_tag", tagged("tokens", lexicon))
                     .withColumn("objects", objects_of("tokens", "_tag"))
                     .withColumn("errors", errors_of("tokens", "_tag"))
                     .withColumn("kinds", F.col("_tag.k")).drop("_tag"))


def with_errors(sequences: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Add the ordered ``errors`` array."""
    return sequences.withColumn("_tag", tagged("tokens", lexicon)).withColumn("errors", errors_of("tokens", "_tag")).drop("_tag")


def reconstruct(sequences: DataFrame, lexicon: Lexicon = DEFAULT, key: str = KEY) -> DataFrame:
    """Object rows ``(key, sequence, token, x_step, y_lane, width)``."""
    rows = sequences.select(key, "tokens").withColumn("_tag", tagged("tokens", lexicon))
    return (unnest(rows, key, _o=objects_of("tokens", "_tag"))
            .select(key, F.col("pos").cast("bigint").alias("sequence"), "_o.*"))


# -- comparison with the placed objects --------------------------------------
def gameplay_rows(gameplay: DataFrame, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Gameplay objects with their dense position ``sequence`` in event order, one row each."""
    from lanestride.operators.objects import event_order
    order = ["x_step", "rank", "y_lane", "object_id", "token", "width"]
    return ordered_index(event_order(gameplay, lexicon), [KEY], F.floor(F.col("x_step") / 256), order, "sequence").select(
        KEY, "sequence", "token", "x_step", "y_lane", "width")


def roundtrip_check(sequences: DataFrame, expected: DataFrame, recorded: DataFrame | None = None, lexicon: Lexicon = DEFAULT) -> DataFrame:
    """Compare reconstructed objects with gameplay rows ``(level_id, sequence, token, x_step, y_lane, width)``.

    Both sides are rows and meet on (level, sequence), so a level of any length
    spreads over the exchange.  ``recorded`` names the levels that have a
    gameplay record; without it, those with a row do.
    """
    solid = lexicon.is_in("token", "solids")
    want = expected.select(KEY, F.col("sequence").cast("bigint").alias("sequence"), F.struct(
        "token", F.coalesce("x_step", F.lit(0)).cast("bigint").alias("x_step"), F.coalesce("y_lane", F.lit(0)).cast("bigint").alias("y_lane"),
        F.expr(f"CASE WHEN {solid} THEN coalesce(width, 1) ELSE 1 END").cast("bigint").alias("width")).alias("_want"))
    got = reconstruct(sequences, lexicon).select(KEY, "sequence", F.struct(
        "token", F.col("x_step").cast("bigint").alias("x_step"), F.col("y_lane").cast("bigint").alias("y_lane"), F.col("width").cast("bigint").alias("width")).alias("_got"))
    both = got.join(want, [KEY, "sequence"], "full_outer").groupBy(KEY).agg(
        F.count("_got").alias("_n"), F.count("_want").alias("_m"), F.max("_got.x_step").alias("_x"),
        F.min(F.when(F.col("_got") != F.col("_want"), F.col("sequence"))).alias("_at"))
    known = (expected if recorded is None else recorded).select(KEY).distinct().withColumn("_known", F.lit(True))
    rows = with_errors(sequences.select(KEY, "tokens"), lexicon).join(both, KEY, "left").join(known, KEY, "left")
    n, m = F.coalesce("_n", F.lit(0)).cast("bigint"), F.coalesce("_m", F.lit(0)).cast("bigint")
    reason = (F.when(F.size("errors") > 0, "invalid_grammar").when(F.col("_known").isNull(), "missing_gameplay_record")
               .when(n != m, "object_count_mismatch").when(F.col("_at").isNotNull(), "object_mismatch").otherwise(""))
    return rows.withColumn("reason", reason).select(
        KEY, (F.col("reason") == "").alias("valid"), "reason", F.slice("errors", 1, 20).alias("grammar_errors"),
        F.when(F.col("reason") == "object_mismatch", F.col("_at")).otherwise(F.lit(-1)).cast("bigint").alias("mismatch_index"),
        n.alias("reconstructed_object_count"), F.when(F.col("_known").isNull(), 0).otherwise(m).cast("bigint").alias("expected_object_count"),
        F.coalesce("_x", F.lit(0)).cast("bigint").alias("max_x_step"))


def roundtrip_summary(checks: DataFrame) -> DataFrame:
    per_reason = checks.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    n, good = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("reason") == "", F.col("n"))), F.lit(0))
    return per_reason.agg(
        n.alias("levels_validated"), good.alias("levels_valid"), (n - good).alias("levels_invalid"),
        F.map_from_entries(F.array_sort(F.array_compact(F.collect_list(
            F.when(F.col("reason") != "", F.struct("reason", "n")))))).alias("invalid_reasons"))


# -- sequence statistics ------------------------------------------------------
def max_repetition(tokens: str) -> Column:
    """Longest run of equal tokens: the widest gap between change positions."""
    breaks = (f"concat(filter(transform({tokens}, (t, i) -> CASE WHEN i = 0 OR NOT (t <=> get({tokens}, i - 1)) THEN i END), "
              f"x -> x IS NOT NULL), array(size({tokens})))")
    return F.expr(f"CASE WHEN coalesce(size({tokens}), 0) <= 0 THEN 0 ELSE "
                  + _bind(breaks, "c", "array_max(transform(c, (x, i) -> CASE WHEN i = 0 THEN 0 ELSE x - get(c, i - 1) END))")
                  + " END").cast("bigint")


def transition_counts(sequences: DataFrame) -> DataFrame:
    """Bigram counts over a corpus; pairs are made inside each row and combined map-side."""
    pair = F.expr("zip_with(slice(tokens, 1, greatest(0, size(tokens) - 1)), "
                  "slice(tokens, 2, greatest(0, size(tokens) - 1)), (a, b) -> struct(a AS token, b AS next_token))")
    return (unnest(sequences, p=pair)
                     .groupBy("p.token", "p.next_token").agg(F.count(F.lit(1)).alias("count")))


def illegal_transitions(sequences: DataFrame, lexicon: Lexicon = DEFAULT, min_generated: int = 0,
                        max_consecutive_steps: int = 6, key: str = KEY) -> DataFrame:
    """Positions whose token the generation rules do not allow.

    A pair is looked up in a small allowed-bigram table.  A lane mark is a
    solid's if the nearest mechanic before it, with no step or prefix mark
    between, is a solid.  A step mark is also illegal after
    ``max_consecutive_steps`` of them, an end mark before position
    ``min_generated``, except after a token of no class, which only an end may
    follow.  After a sequence has ended nothing may follow.
    """
    kind = {START: "start", DIFF: "difficulty", ALIGN: "align", SOLID: "solid", MECH: "mechanic", STEP: "step", WIDTH: "width", END: "end"}
    names = " ".join(f"WHEN {k} THEN {sql_text(v)}" for k, v in kind.items())
    marks = "filter(transform(g, (e, i) -> CASE WHEN e IN ({}) THEN i END), i -> i IS NOT NULL)".format(f"{SOLID}, {MECH}, {STEP}, {START}, {ALIGN}, {DIFF}")
    # the mark at or before each position, written out run by run
    held = _bind(marks, "m", "concat(array_repeat(-1, coalesce(get(m, 0), size(g))), "
                             "flatten(transform(m, (p, j) -> array_repeat(get(g, p), coalesce(get(m, j + 1), size(g)) - p))))")
    lane = f"WHEN {LANE} THEN CASE WHEN get(h, i) = {SOLID} THEN 'solid_lane' ELSE 'lane' END"
    codes = f"transform(tokens, t -> {kind_sql('t', lexicon)})"
    kinds = _bind(codes, "g", _bind(held, "h", f"transform(g, (e, i) -> CASE e {names} {lane} ELSE 'other' END)"))
    legal = " OR ".join(f"(a = {sql_text(x)} AND b = {sql_text(y)})" for x, y in lexicon.transitions())
    last_step = max_consecutive_steps
    run = f"forall(sequence(1, {last_step}), d -> coalesce(get(kinds, i - d), '-') = 'step')"
    bad = (f"transform(kinds, (b, i) -> CASE WHEN i = 0 THEN b <> 'start' ELSE {_bind('get(kinds, i - 1)', 'a', f'NOT ({legal})')} "
           f"OR (b = 'step' AND {run}) OR (b = 'end' AND i < {min_generated} AND get(kinds, i - 1) <> 'other') END)")
    return (unnest(sequences.select(key, "tokens", F.expr(kinds).alias("kinds")), key, r=F.expr(
                f"filter(zip_with(zip_with({bad}, tokens, (x, t) -> struct(x AS bad, t AS token)), "
                "sequence(0, greatest(0, size(tokens) - 1)), (s, p) -> struct(s.bad AS bad, s.token AS token, p AS pos, "
                "get(tokens, p - 1) AS after)), r -> r.bad)"))
            .select(key, F.col("r.pos").cast("bigint").alias("pos"), F.col("r.after").alias("after"), F.col("r.token").alias("token")))


def close_sequence(tokens: str, lexicon: Lexicon = DEFAULT) -> Column:
    """Complete an open sequence: missing lane / width / align, then step and end."""
    q = sql_text
    last = f"element_at({tokens}, -1)"
    here = kind_sql(last, lexicon)
    filler = (f"CASE {here} WHEN {SOLID} THEN array({q('Y0')}, {q('WIDTH_1')}) WHEN {MECH} THEN array({q('Y0')}) "
              f"WHEN {LANE} THEN CASE WHEN {open_solid_sql(tokens, lexicon)} THEN array({q('WIDTH_1')}) ELSE array() END "
              f"WHEN {DIFF} THEN array({q(lexicon.align)}) ELSE array() END")
    step = f"CASE WHEN {last} = {q(lexicon.step)} THEN array() ELSE array({q(lexicon.step)}) END"
    empty = f"array({q(lexicon.start)}, 'DIFF_NA', {q(lexicon.align)}, {q(lexicon.step)}, {q(lexicon.end)})"
    return F.expr(f"CASE WHEN coalesce(size({tokens}), 0) <= 0 THEN {empty} ELSE "
                  f"concat({tokens}, {filler}, {step}, array({q(lexicon.end)})) END")


def open_solid_sql(tokens: str, lexicon: Lexicon) -> str:
    """Whether the nearest earlier mechanic, not crossing a step or prefix mark, is a solid."""
    before = f"reverse(slice({tokens}, 1, size({tokens}) - 1))"
    seen = f"filter(transform({before}, t -> {kind_sql('t', lexicon)}), k -> k IN ({SOLID}, {MECH}, {STEP}, {START}, {ALIGN}, {DIFF}))"
    return f"coalesce(get({seen}, 0), -1) = {SOLID}"


def unknown_tokens(tokens: str, known: tuple[str, ...]) -> Column:
    """Tokens outside the known set, in order, with repeats."""
    inside = ", ".join(sql_text(t) for t in known)
    return F.expr(f"filter({tokens}, t -> t NOT IN ({inside}))")


def generation_validity(sequences: DataFrame, lexicon: Lexicon = DEFAULT, known: tuple[str, ...] | None = None,
                        key: str = KEY) -> DataFrame:
    """Grammar errors plus one sorted ``unknown_token:`` error per token outside ``known``."""
    strange = unknown_tokens("tokens", known or lexicon.base_vocabulary)
    extra = F.expr("transform(array_sort(array_distinct(_strange)), t -> concat('unknown_token:', t))")
    return (with_errors(sequences.withColumn("_strange", strange), lexicon)
            .select(key, "tokens", "_strange", F.concat("errors", extra).alias("errors"))
            .select(key, (F.size("errors") == 0).alias("valid"), "errors",
                    F.size("_strange").cast("bigint").alias("invalid_token_count"),
                    F.round(F.size("_strange") / F.greatest(F.size("tokens"), F.lit(1)), 6).alias("invalid_token_rate")))
