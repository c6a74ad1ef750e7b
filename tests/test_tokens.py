"""Objects, emission, grammar and quality on small fixtures and against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from lanestride.dims import DEFAULT as LEX
from lanestride.operators import emit as E, grammar as G, layout as P, objects as O, quality as Q
from lanestride.operators.spread import attach


def seqs(spark, *token_lists):
    return spark.createDataFrame([(i, t) for i, t in enumerate(token_lists)], "level_id BIGINT, tokens ARRAY<STRING>")


def objs(spark, rows):
    return spark.createDataFrame([(1, i, o, float(x), float(y)) for i, (o, x, y) in enumerate(rows)],
                                 "level_id BIGINT, seq BIGINT, object_id BIGINT, x DOUBLE, y DOUBLE")


def level(spark, difficulty="hard"):
    return spark.createDataFrame([(1, difficulty, "s")], "level_id BIGINT, difficulty STRING, source STRING")


EASY = E.Limits(min_gameplay_objects=1, min_tokens=1)
ROW = [(40, 45, 15), (40, 75, 15), (39, 165, 75), (84, 165, 135), (47, 255, 105)]


def tokens_of(spark, rows, limits=EASY):
    play = O.gameplay_objects(objs(spark, rows))
    return E.emit_tokens(play, level(spark), limits=limits).first()


def test_base_vocabulary():
    assert len(LEX.base_vocabulary) == 67 and LEX.base_vocabulary[2] == "START"


def test_merge_and_order(spark):
    got = " ".join(tokens_of(spark, ROW)["tokens"])
    assert got == "START DIFF_HARD ALIGN_UNKNOWN PLATFORM Y0 WIDTH_2" + " STEP" * 4 + " SPIKE Y2 ORB_BLUE Y4" + " STEP" * 3 + " PORTAL_BALL Y3 STEP END"


def test_long_run_is_truncated(spark):
    rows = O.gameplay_objects(objs(spark, [(1, 30 * i, 0) for i in range(40)])).collect()
    assert [(r.x_step, r.width) for r in rows] == [(0, 16)]


def test_runs_across_chunks(spark):
    """Runs that touch chunk borders keep their start and width, for any chunk size."""
    steps = [i for i in range(400) if random.Random(i).random() < 0.8]
    frame = spark.createDataFrame([(1, n, 1, float(n), float(s * 30), 0.0, "BLOCK", s, 0) for n, s in enumerate(steps)],
                                  "level_id BIGINT, seq BIGINT, object_id BIGINT, n DOUBLE, x DOUBLE, y DOUBLE, token STRING, x_step BIGINT, y_lane BIGINT")
    want, start = [], steps[0]
    for a, b in zip(steps, steps[1:] + [None]):
        if b != a + 1:
            want.append((start, min(16, a - start + 1)))
            start = b
    got = sorted((r.x_step, r.width) for r in O.merge_runs(frame, chunk_steps=20).collect())
    assert got == want


def test_one_timestep_is_rejected(spark):
    rows = [(8, 15, 15), (36, 15, 75), (13, 15, 135)]
    o = objs(spark, rows)
    play = O.gameplay_objects(o)
    stats = E.stats_records(o, play, E.emit_tokens(play, level(spark), limits=EASY), limits=EASY).first()
    assert stats["reason"] == "all_objects_one_timestep" and not stats["accepted"]


def emit_loop(items, cap):
    tokens, current = ["START", "DIFF_HARD", "ALIGN_UNKNOWN"], 0
    for step in sorted({i[0] for i in items}):
        if len(tokens) + step - current > cap:
            return tokens, True
        tokens += ["STEP"] * (step - current)
        for _, rank, lane, oid, token, width in sorted(i for i in items if i[0] == step):
            tokens += [token, f"Y{lane}"] + ([f"WIDTH_{width}"] if token in LEX.solids else [])
            if len(tokens) > cap:
                return tokens, True
        current = step
    return tokens + ["STEP", "END"], False


@pytest.mark.parametrize("cap", [3, 10, 17, 18, 19, 20, 25, 40, 10_000])
def test_length_cap_matches_loop(spark, cap):
    rng = random.Random(cap)
    rows = [(rng.choice([1, 8, 36, 40, 12]), rng.randrange(0, 900), rng.randrange(0, 400)) for _ in range(30)] + [(8, 30 * cap + 300, 0)] * (cap < 100)
    play = O.gameplay_objects(objs(spark, rows))
    items = [(r.x_step, LEX.mechanics.index(r.token), r.y_lane, r.object_id, r.token, r.width) for r in play.collect()]
    got = E.emit_tokens(play, level(spark), limits=E.Limits(max_token_length=cap)).first()
    want, over = emit_loop(items, cap)
    assert got["tokens"] == want and (got["emit_error"] is not None) == over


def test_empty_level(spark):
    play = O.gameplay_objects(objs(spark, [(99999, 1, 1)]))
    assert E.emit_tokens(play, level(spark, "nope")).first()["tokens"] == ["START", "DIFF_NA", "ALIGN_UNKNOWN", "STEP", "END"]


def test_difficulty_labels(spark):
    rows = spark.createDataFrame([(" Insane Demon ",), ("easy_demon",), ("",), (None,), ("AUTO",)], "d STRING")
    assert [r[0] for r in rows.select(O.difficulty_token("d")).collect()] == ["DIFF_INSANE", "DIFF_EASY", "DIFF_NA", "DIFF_NA", "DIFF_AUTO"]


# -- grammar -------------------------------------------------------------------
def random_sequences(n, seed=5):
    rng = random.Random(seed)
    pool = ["START", "END", "STEP", "STEP", "ALIGN_UNKNOWN", "DIFF_HARD", "BLOCK", "BLOCK", "SPIKE", "ORB_BLUE", "PORTAL_SHIP", "PAD_BLUE",
            "Y0", "Y1", "Y3", "Y9", "WIDTH_1", "WIDTH_4", "odd", "<UNK>"]
    out = [[]]
    for _ in range(n):
        head = rng.choice([[], ["START"], ["START", "DIFF_HARD", "ALIGN_UNKNOWN"], ["START", "ALIGN_UNKNOWN"]])
        out.append(head + [rng.choice(pool) for _ in range(rng.randrange(0, 25))] + rng.choice([[], ["END"]]))
    return out


def test_grammar_by_cases(spark):
    head = "START DIFF_EASY ALIGN_UNKNOWN "
    cases = {
        "": (["empty_sequence"], []),
        head + "SAW Y4 STEP PLATFORM Y2 WIDTH_3 STEP END": ([], [("SAW", 0, 4, 1), ("PLATFORM", 1, 2, 3)]),
        head + "SAW STEP END": (["missing_y_after:SAW"], []),
        head + "PLATFORM Y2 STEP END": (["missing_width_after:PLATFORM"], []),
        head + "SAW Y1 WIDTH_2 STEP END": (["unexpected_width_after:SAW"], [("SAW", 0, 1, 1)]),
        head + "STEP WIDTH_2 END": (["orphan_width_token:WIDTH_2"], []),
        head + "START ALIGN_UNKNOWN huh END": (["unexpected_start", "unexpected_prefix_token:ALIGN_UNKNOWN", "unknown_token:huh"], []),
        "SAW Y1": (["missing_start", "missing_end", "orphan_y_token:Y1"], []),
        head + "END STEP END": (["tokens_after_end"], []),
    }
    rows = G.with_objects(seqs(spark, *[c.split() for c in cases])).collect()
    for row in rows:
        errors, objects = cases[" ".join(row.tokens)]
        assert row.errors == errors and [tuple(o) for o in row.objects] == objects, row.tokens


def test_legal_sequence(spark):
    t = "START DIFF_HARD ALIGN_UNKNOWN BLOCK Y1 WIDTH_4 SPIKE Y2 STEP ORB_YELLOW Y5 STEP END".split()
    rows = G.reconstruct(seqs(spark, t)).orderBy("sequence").collect()
    assert [(r.token, r.x_step, r.y_lane, r.width) for r in rows] == [("BLOCK", 0, 1, 4), ("SPIKE", 0, 2, 1), ("ORB_YELLOW", 1, 5, 1)]


def test_close_sequence(spark):
    cases = {"START DIFF_HARD ALIGN_UNKNOWN BLOCK Y3": "WIDTH_1 STEP END", "START": "STEP END", "START DIFF_HARD": "ALIGN_UNKNOWN STEP END",
             "START BLOCK": "Y0 WIDTH_1 STEP END", "START SPIKE": "Y0 STEP END", "START SPIKE Y1": "STEP END", "START STEP": "END"}
    rows = seqs(spark, *[c.split() for c in cases]).select("tokens", G.close_sequence("tokens").alias("c")).collect()
    for r in rows:
        assert r.c == r.tokens + cases[" ".join(r.tokens)].split()


def test_emit_reconstruct_round_trip(spark):
    rng = random.Random(3)
    ids = [i for ids in LEX.raw_ids.values() for i in ids]
    rows = [(lv, n, rng.choice(ids), rng.uniform(0, 3000), rng.uniform(0, 500)) for lv in range(20) for n in range(80)]
    o = spark.createDataFrame(rows, "level_id BIGINT, seq BIGINT, object_id BIGINT, x DOUBLE, y DOUBLE")
    lv = o.select("level_id").distinct().selectExpr("level_id", "'hard' AS difficulty", "'' AS source")
    play = O.gameplay_objects(o)
    checks = G.roundtrip_check(E.emit_tokens(play, lv), G.gameplay_rows(play)).collect()
    assert len(checks) == 20 and all(c.valid and c.expected_object_count > 0 for c in checks)
    shuffled = O.gameplay_objects(o.repartition(7, "x"))
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, play.collect()))


def test_round_trip_has_no_step_limit(spark):
    o = spark.createDataFrame([(1, 0, 1, 15.0, 15.0), (1, 1, 8, 15.0 + 30 * 20_000, 15.0), (2, 0, 1, 15.0, 15.0)],
                              "level_id BIGINT, seq BIGINT, object_id BIGINT, x DOUBLE, y DOUBLE")
    lv = o.select("level_id").distinct().selectExpr("level_id", "'hard' AS difficulty", "'' AS source")
    play = O.gameplay_objects(o)
    sequences = E.emit_tokens(play, lv, limits=E.Limits(max_token_length=50_000))
    checks = {c.level_id: c for c in G.roundtrip_check(sequences, G.gameplay_rows(play)).collect()}
    assert checks[1].valid and checks[1].expected_object_count == 2 and checks[1].max_x_step == 20_000
    lost = G.gameplay_rows(play).where("sequence = 0 AND level_id = 1")
    checks = {c.level_id: c.reason for c in G.roundtrip_check(sequences, lost).collect()}
    assert checks == {1: "object_count_mismatch", 2: "missing_gameplay_record"}


def test_lane_marks_belong_to_the_nearest_mechanic(spark):
    head = "START DIFF_HARD ALIGN_UNKNOWN "
    cases = {head + "BLOCK Y1 Y2 SPIKE": [(5, "Y2"), (6, "SPIKE")], head + "BLOCK Y1 WIDTH_1 Y2 WIDTH_2": [(6, "Y2")], "START zzz END": [(1, "zzz")],
             head + "SPIKE Y1 WIDTH_1": [(5, "WIDTH_1")], "": [], "Y1 STEP": [(0, "Y1")]}
    rows = spark.createDataFrame([(i, c.split()) for i, c in enumerate(cases)], "level_id BIGINT, tokens ARRAY<STRING>")
    found = {}
    for r in G.illegal_transitions(rows, min_generated=40).collect():
        found.setdefault(r.level_id, []).append((r.pos, r.token))
    assert [sorted(found.get(i, [])) for i in range(len(cases))] == list(cases.values())


def test_numbers_out_of_range_do_not_stop_a_job(spark):
    from lanestride.operators import layout as P
    odd = spark.createDataFrame([(1e22,), (float("nan"),), (float("-inf"),), (45.0,)], "x DOUBLE")
    steps = odd.select(O.quantize_step(F.col("x"), F.lit(15.0), 30.0).alias("s"), O.quantize_lane(F.col("x"), F.lit(0.0), 30.0, 16).alias("l")).collect()
    assert steps[3].s == 1 and steps[0].l == 15 and steps[2].s == 0 and all(0 <= r.l <= 15 for r in steps)
    texts = ["1,nan,2,3,3,4", "1,1e30,2,3,3,4", "1,5,2,nan,3,4", "1,inf,2,3,3,4", "1,5,2,3,3,4", "1,0.5,2,3,3,4"]
    valid = spark.createDataFrame([(t,) for t in texts], "raw STRING")
    assert [r.v for r in valid.select(P.valid_object_string("raw").alias("v")).collect()] == [False, True, False, False, True, False]
    assert [r.raw for r in P.parse_reference_objects(valid).collect()] == [texts[1], texts[4], texts[5]]


def test_floor_and_blocked_path(spark):
    head = "START DIFF_HARD ALIGN_UNKNOWN".split()
    floor = head + ["BLOCK", "Y0", "WIDTH_8"] + ["STEP"] * 16 + ["END"]
    wall = head + ["STEP"] * 3 + ["BLOCK", "Y1", "WIDTH_1"] + ["STEP"] * 13 + ["END"]
    rows = {r.level_id: r for r in Q.quality_report(seqs(spark, floor, wall)).collect()}
    assert rows[0].path_obstructions == 0 and rows[1].path_obstructions > 0 and rows[0].valid


def test_lane_path_agrees_with_metrics(spark):
    rows = G.with_objects(seqs(spark, *random_sequences(400, 9))).select(
        Q.lane_path("objects").alias("p"), Q.path_metrics("objects").alias("m")).collect()
    for r in rows:
        pairs = list(zip(r.p, r.p[1:]))
        assert r.m.gaps == sum(b.step - a.step > 6 for a, b in pairs) and r.m.jumps == sum(abs(b.lane - a.lane) > 4 for a, b in pairs)


# -- layouts -------------------------------------------------------------------
def admissible(item, before):
    """Width granted to an object, or None, by what the rules say about the objects admitted before it."""
    _, token, step, lane, width = item
    kinds = [LEX.portals, LEX.gravity, LEX.speed]
    kind = next((k for k in kinds if token in k), None)
    solids = [o for o in before if o[1] in LEX.solids]
    cells = {(o[2] + d, o[3]) for o in solids for d in range(o[4])} | {(o[2], o[3]) for o in before if o[1] in LEX.orbs + LEX.pads + LEX.hazards}
    if token in LEX.solids:
        free = sum((step + d, lane) not in cells for d in range(width))
        return min(width, free) if free and all(o[2] != step for o in solids) else None
    here = [o for o in before if o[2] == step and o not in solids]
    apart = step - max((o[2] for o in before if o[1] in kind), default=-99) >= 8 if kind else (step, lane) not in cells
    return width if len(here) < 2 and apart and all(o[1:4] != (token, step, lane) for o in here) else None


@pytest.mark.parametrize("pauses", [0.1, 0.0])
def test_every_admission_follows_from_the_earlier_ones(spark, pauses, monkeypatch):
    rng = random.Random(11)
    rows = []
    for lv in range(12):
        step = 0
        for n in range(300):
            step += rng.choice([0, 0, 0, 1, 1, 2, 9 if rng.random() < pauses else 0])
            token = rng.choice(LEX.mechanics)
            rows.append((lv, n, token, step, rng.randrange(1, 9), rng.randrange(1, 9) if token in LEX.solids else 1))
    frame = spark.createDataFrame(rows, "level_id BIGINT, sequence BIGINT, token STRING, x_step BIGINT, y_lane BIGINT, width BIGINT")
    clamped = P.clamp_by_class(P.place_objects(frame)).cache()
    got = {(r.level_id, r.sequence): r.width for r in P.admit_objects(clamped).collect()}
    before = {}
    for r in sorted(clamped.collect(), key=lambda r: (r.x_step, r.sequence)):
        earlier = before.setdefault(r.level_id, [])
        item = (r.sequence, r.token, r.x_step, r.y_lane, r.width)
        width = admissible(item, earlier)
        assert got.get((r.level_id, r.sequence)) == width, (r, width)
        if width:
            earlier.append((*item[:4], width))


def test_chunks_keep_foreign_ids(spark):
    rows = [(1, i, 467 if i % 3 else 8, 30.0 * i, 30.0 + 30 * (i % 4)) for i in range(30)]
    raw = spark.createDataFrame([(lv, f"1,{o},2,{x},3,{y},21,1004") for lv, _, o, x, y in rows], "level_id BIGINT, raw STRING")
    chunked = P.chunk_objects(P.parse_reference_objects(raw))
    scored = P.score_chunks(chunked)
    out = P.stitch(chunked, P.select_chunks(scored, 96, F.lit(0))).withColumn("raw", P.rewrite_property("raw", "2", F.col("x"))).collect()
    assert len(out) == 90 and {r.token for r in out} == {"SPIKE", "OBJ_467"}
    assert all(",21,1004" in r.raw for r in out) and sorted(r.sequence for r in out) == list(range(90))


# -- hot keys ------------------------------------------------------------------
def test_facts_reach_every_row(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 2 = 0 THEN 0 ELSE id % 50 END AS level_id", "id AS seq")
    facts = rows.where("level_id <> 7").groupBy("level_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("top"))
    want = sorted(map(tuple, rows.join(facts, "level_id").select("level_id", "seq", "n", "top").collect()))
    assert sorted(map(tuple, attach(rows, facts, "level_id").collect())) == want
    assert attach(rows, facts, "level_id", keep_unmatched=True).count() == 5000




def test_vocab_total_counts_tokens_once_and_numbers_none(spark):
    from lanestride.plans.registry import QUERIES
    plan = QUERIES["vocab_total"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "Join" not in plan


def test_vocabulary_reads_its_sequences_once(spark):
    from pyspark.sql import functions as F
    from lanestride.operators import vocabulary as V
    told = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(i):
        told.add(1)
        return ["START", f"t{i % 7}"]
    rows = spark.range(30).select(F.col("id").alias("level_id"), tokens("id").alias("tokens"))
    found = V.build_vocabulary(rows, "level_id").collect()
    assert told.value == 30 and {r.token: r["count"] for r in found}["START"] == 30 and sum(r["count"] for r in found) == 60
