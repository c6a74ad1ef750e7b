"""Series features against direct computation."""
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from lanestride.operators import align as L, ngram as N, series as X, vocabulary as V
from lanestride.operators.spread import halo, islands, order_statistic, ordered_index
from lanestride.sources.readers import read_wave_files


def greedy(times, gap):
    kept = []
    for t in sorted(set(times)):
        if not kept or t - kept[-1] >= gap:
            kept.append(t)
    return kept


@pytest.mark.parametrize("gap,density", [(5, 0.05), (5, 0.9), (40, 0.9), (300, 0.5)])
def test_min_gap_matches_walk(spark, gap, density):
    rng = random.Random(gap)
    rows = [(s, t) for s in range(6) for t in range(-500, 2500) if rng.random() < density for _ in range(rng.choice([1, 1, 3]))]
    got = {}
    for r in X.min_gap(spark.createDataFrame(rows, "series BIGINT, t BIGINT").repartition(5), ["series"], "t", gap).collect():
        got.setdefault(r.series, []).append(r.t)
    assert {k: sorted(v) for k, v in got.items()} == {s: greedy([t for k, t in rows if k == s], gap) for s in range(6)}


@pytest.mark.parametrize("chunk", [1, 3, 16])
def test_min_gap_of_one_key_over_many_chunks(spark, chunk):
    """No pause, equal positions, steps that only floating-point differences decide, and a gap wider than a chunk."""
    rng = random.Random(chunk)
    rows = [(s, round(t * 0.1, 1)) for s in range(2) for t in range(120)] + [(2, rng.random() * 9) for _ in range(150)] + [(3, 5.0), (3, None), (3, float("nan")), (None, 1.0)]
    for gap in (0.16, 0.3, 2.5):
        got = {}
        for r in X.min_gap(spark.createDataFrame(rows, "series BIGINT, t DOUBLE").repartition(3), ["series"], "t", gap, chunk).collect():
            got.setdefault(r.series, []).append(r.t)
        assert {k: sorted(v) for k, v in got.items()} == {s: greedy([t for k, t in rows if k == s and t is not None and t == t], gap) for s in range(4)}


def test_min_gap_without_a_gap_or_rows(spark):
    rows = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "k INT, t INT")
    assert sorted(r.t for r in X.min_gap(rows, ["k"], "t", 0).collect()) == [2, 3]
    none = X.min_gap(rows.limit(0), ["k"], "t", 5)
    assert none.count() == 0 and none.dtypes == rows.dtypes


def test_islands(spark):
    rows = [(1, t) for t in (0, 3, 7, 30, 34, 60)]
    got = {r.t: (r._island, r._island_end) for r in islands(spark.createDataFrame(rows, "k INT, t BIGINT"), ["k"], "t", 10).collect()}
    assert got == {0: (0, 7), 3: (0, 7), 7: (0, 7), 30: (30, 34), 34: (30, 34), 60: (60, 60)}


def test_order_statistic_is_exact(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice([rng.uniform(-9e5, 9e5), float(rng.randrange(5)), 1e-9 * rng.random(), rng.choice([-1, 1]) * 10.0 ** rng.randrange(3, 22)])) for k in range(8) for _ in range(50 * k + 1)]
    got = order_statistic(spark.createDataFrame(rows, "k INT, v DOUBLE"), ["k"], "v", F.bround((F.col("n") - 1) * 0.3, 0), "q").collect()
    for r in got:
        values = sorted(v for k, v in rows if k == r.k)
        assert r.q == values[round((len(values) - 1) * 0.3)] and r.n == len(values)
    assert len(got) == 8


def test_ordered_index_and_halo(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    dense = ordered_index(rows, ["k"], F.floor(F.col("v") / 100), ["v"], "i")
    for k in range(3):
        assert [r.i for r in dense.where(f"k = {k}").orderBy("v").collect()] == list(range(len(range(k, 1000, 3))))
    near = halo(dense, "i", 2, 1, 16)
    assert near.where("_own").count() == 1000 and near.count() > 1000


def pulse(rate=8000, seconds=2.4, period=0.4):
    """A loud tick at every period over a quiet hum."""
    return [(0.9 if t % period < 0.06 else 0.1) * math.sin(2 * math.pi * 300 * t) for t in (n / rate for n in range(int(rate * seconds)))]


def write_wave(path, samples, rate=8000, channels=1):
    data = b"".join(struct.pack("<h", int(v * 32767)) * channels for v in samples)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, 1, channels, rate,
                       rate * 2 * channels, 2 * channels, 16, b"data", len(data))
    path.write_bytes(head + data)


def test_pulse_tempo(spark, tmp_path):
    write_wave(tmp_path / "a.wav", pulse())
    write_wave(tmp_path / "b.wav", pulse(seconds=3.23), channels=2)
    (tmp_path / "bad.wav").write_bytes(b"RIFFxxxx")
    raw = read_wave_files(spark, str(tmp_path)).withColumn("series", F.when(F.col("track") == "a.wav", 0).otherwise(1).cast("bigint"))
    assert {r["series"]: r["n"] for r in raw.groupBy("series").agg(F.count("*").alias("n")).collect()} == {0: 19200, 1: 25840}
    assert raw.agg(F.max(F.abs("sample"))).first()[0] <= 1.0
    energy = X.smooth3(X.minmax_normalise(X.rms_by_index(raw, F.col("rate"))))
    onsets = X.min_gap(X.onset_candidates(energy), ["series"], "t", 0.16)
    bpm = X.tempo(onsets, energy)
    lengths = X.sample_durations(raw, F.col("rate"))
    assert {r.series: r.duration for r in lengths.collect()} == {0: 2.4, 1: 3.23}
    beats = X.beat_grid(bpm, onsets, lengths)
    for r in bpm.collect():
        assert 80 <= r.bpm <= 210
    assert all(r["n"] > 2 for r in beats.groupBy("series").agg(F.count("*").alias("n")).collect())


def test_short_series(spark):
    rows = [(1, 0, 0.0, 3.0), (2, 0, 0.0, 1.0), (2, 1, 0.1, 5.0)]
    energy = X.smooth3(X.minmax_normalise(spark.createDataFrame(rows, "series BIGINT, idx BIGINT, t DOUBLE, value DOUBLE")))
    assert sorted((r.series, r.value) for r in energy.collect()) == [(1, 0.0), (2, 0.0), (2, 1.0)]
    assert X.onset_candidates(energy).count() == 0
    assert {r.series: r.bpm for r in X.tempo(X.onset_candidates(energy).select("series", "t"), energy).collect()} == {1: 120, 2: 120}


def test_spaced_top_k_matches_walk(spark):
    rng = random.Random(2)
    pri = [(s, st, round(rng.uniform(2, 6), 6)) for s in range(4) for st in range(2, 60) if rng.random() < 0.6]
    eng = [(s, st, rng.random()) for s in range(4) for st in range(64)]
    plans = spark.createDataFrame([(s, 62) for s in range(4)], "series BIGINT, planned BIGINT")
    counts = spark.createDataFrame([(s, k) for s, k in enumerate((3, 10, 25, 55))], "series BIGINT, object_count BIGINT")
    got = L.spaced_top_k(spark.createDataFrame(pri, "series BIGINT, step BIGINT, priority DOUBLE"),
                         spark.createDataFrame(eng, "series BIGINT, step BIGINT, energy DOUBLE"), plans, counts).collect()
    for s, k in enumerate((3, 10, 25, 55)):
        picked = []
        for _, st in sorted(((-p, st) for x, st, p in pri if x == s)):
            if len(picked) < k and all(abs(st - o) >= 2 for o in picked):
                picked.append(st)
        energy = {st: e for x, st, e in eng if x == s}
        rest = sorted((st for st in range(2, 60) if st not in picked), key=lambda st: -energy[st])[:k - len(picked)]
        assert sorted(r.step for r in got if r.series == s and r.stage == "spaced") == sorted(picked)
        assert sorted(r.step for r in got if r.series == s and r.stage == "fill") == sorted(rest)


@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_separated_peaks_match_walk(spark, chunk):
    """Long slopes, plateaus split by the tie, single steps and gaps."""
    rng = random.Random(chunk)
    rows = [(0, st, float(st)) for st in range(40)] + [(1, st, float(-st)) for st in range(40)] + [(2, st, float(rng.randrange(3))) for st in range(80) if rng.random() < 0.9]
    rows += [(3, st, float(abs(st - 20))) for st in range(41)] + [(4, 7, 1.0)]
    frame = spark.createDataFrame(rows, "series BIGINT, step BIGINT, priority DOUBLE").repartition(3)
    got = L.separated_peaks(frame, "step", F.struct(-F.col("priority"), "step"), chunk).collect()
    for s in range(5):
        taken = set()
        for _, st in sorted((-p, st) for x, st, p in rows if x == s):
            if not taken & {st - 1, st + 1}:
                taken.add(st)
        assert {r.step for r in got if r.series == s} == taken


def test_vocabulary_merge_is_append_only(spark):
    base = spark.createDataFrame([(0, "START", 1), (1, "STEP", 2)], "token_id BIGINT, token STRING, count BIGINT")
    batch = spark.createDataFrame([(1, ["START", "NEW_MECHANIC", "STEP"])], "level_id BIGINT, tokens ARRAY<STRING>")
    rows = {r.token: (r.token_id, r["count"]) for r in V.merge_vocabulary(base, batch, "level_id").collect()}
    assert rows["START"] == (0, 2) and rows["STEP"] == (1, 3) and rows["NEW_MECHANIC"] == (67, 1) and len(rows) == 68
    meta = spark.createDataFrame([(1, 0, 2)], "vocab_version BIGINT, frequency_revision BIGINT, unknown_object_count BIGINT")
    assert tuple(V.merge_meta(meta, base, batch).first()) == (2, 1, 2)
    assert tuple(V.merge_meta(meta, base, batch.selectExpr("level_id", "array('STEP') AS tokens")).first()) == (1, 1, 2)


def test_split_keeps_one_record_in_train(spark):
    for n, want in ((1, 1), (2, 1), (10, 8), (33, 26)):
        got = N.train_eval_split(spark.range(n).withColumnRenamed("id", "level_id")).where("split = 'train'").count()
        assert got == want


def test_split_takes_records_of_one_hash_in_key_order(spark):
    records = spark.range(1000).selectExpr("id AS level_id")
    for score, first in (("level_id % 3", lambda i: (i % 3, i)), ("7", lambda i: (7, i)), ("-level_id", lambda i: (-i, i))):
        got = N.train_eval_split(records, score=F.expr(score)).where("split = 'train'").collect()
        assert sorted(r.level_id for r in got) == sorted(sorted(range(1000), key=first)[:800])
    repeated = spark.range(100).selectExpr("id % 2 AS level_id", "id AS n")
    got = N.train_eval_split(repeated, score=F.lit(1))
    assert got.count() == 100 and sorted(r.level_id for r in got.where("split = 'train'").collect()) == [0] * 50 + [1] * 30
    named = records.selectExpr("string(level_id) AS level_id")
    assert N.train_eval_split(named, score=F.lit(1)).where("split = 'train'").count() == 800


def test_sections_and_report_of_a_series_without_energy(spark):
    rows = [(1, i, i * 0.1, float(i % 5)) for i in range(40)]
    energy = X.smooth3(X.minmax_normalise(spark.createDataFrame(rows, "series BIGINT, idx BIGINT, t DOUBLE, value DOUBLE")))
    lengths = spark.createDataFrame([(1, 4.05, 40), (2, 0.4, 0), (3, 9.0, None)], "series BIGINT, duration DOUBLE, points BIGINT")
    got = {}
    for r in X.sections(energy, lengths).orderBy("series", "section").collect():
        got.setdefault(r.series, []).append((r.start, r.end, r.energy, r.label))
    assert got[2] == [(0.0, 1.0, 0.35, "steady")] and got[3] == [(0.0, 9.0, 0.35, "steady")]
    assert len(got[1]) == 12 and got[1][-1][1] == 4.05
    reports, pages = X.series_analysis(energy, lengths, page=16)
    rep = {r.series: r for r in reports.collect()}
    assert set(rep) == {1, 2, 3} and rep[1].duration == 4.05 and rep[2].bpm == rep[3].bpm == 120 and rep[3].onsets == 0 and rep[3].beats > 10
    assert [s.label for s in rep[3].sections] == ["steady"] and rep[3].sections[0].end == 9.0
    held = {}
    for r in pages.orderBy("series", "kind", "page").collect():
        assert 0 < len(r["values"]) <= 16
        held.setdefault((r.series, r.kind), []).extend(r["values"])
    assert {k: len(v) for k, v in held.items()} == {(s, k): n for s, r in rep.items() for k, n in (("beats", r.beats), ("onsets", r.onsets), ("energy", r.points)) if n}
    assert [v.t for v in held[1, "energy"]] == [round(i * 0.1, 3) for i in range(40)] and all(v.value is not None for v in held[1, "energy"])


def test_profile_prefix_and_bias(spark):
    rows = [(1, 10.0, 120, " Easy ", ["Dense", " flow"]), (2, 10.0, 120, "unheard", None), (3, 10.0, 120, "extreme", ["flow", "DENSE", "odd", " "])]
    got = {r.series: r for r in L.step_profile(spark.createDataFrame(rows, "series BIGINT, duration DOUBLE, bpm BIGINT, difficulty STRING, styles ARRAY<STRING>")).collect()}
    assert [got[s].prefix[1] for s in (1, 2, 3)] == ["DIFF_EASY", "DIFF_HARD", "DIFF_EXTREME"] and got[1].prefix[0] == "START" and got[1].prefix[2] == "ALIGN_UNKNOWN"
    assert got[1].bias == {"BLOCK": 1.08, "SPIKE": 1.18, "ORB_YELLOW": 1.12, "PLATFORM": 1.08, "SAW": 0.85}
    assert got[2].bias == {"BLOCK": 1.08, "PLATFORM": 1.08, "SAW": 0.85} and got[3].bias["BLOCK"] == 1.12


def test_extent_of_decoded_levels_and_gameplay_of_records(spark):
    from lanestride.operators import decompose as R, objects as O
    levels = spark.createDataFrame([(1, "head,x;1,8,2,3.5,3,4;1,9,2,-1,3,2"), (2, ""), (3, None)], "level_id BIGINT, decoded STRING")
    got = {r.level_id: r for r in O.level_extent(R.explode_objects(levels), levels).collect()}
    assert (got[1].header, got[1].decoded_length, got[1].x_min, got[1].x_max) == ("head,x", 33, -1.0, 3.5)
    assert [(got[i].header, got[i].decoded_length, got[i].object_count_raw, got[i].y_max) for i in (2, 3)] == [("", 0, 0, 0.0)] * 2
    play = spark.createDataFrame([(1, "BLOCK", 3, "no"), (1, "SPIKE", 4, "no")], "level_id BIGINT, token STRING, x_step BIGINT, source STRING")
    both = O.tokens_to_gameplay(spark.createDataFrame([(1, "s"), (5, "t")], "level_id BIGINT, source STRING"), play).collect()
    assert sorted((r.level_id, r.source, r.token or "", r.missing) for r in both) == [(1, "s", "BLOCK", False), (1, "s", "SPIKE", False), (5, "t", "", True)]


def test_bias_table_takes_the_later_style_without_grouping_by_token(spark):
    from lanestride.dims import STYLE_BIAS
    rng = random.Random(4)
    rows = [(k, o, rng.choice([*STYLE_BIAS, "Flow", "none"])) for k in range(40) for o in range(rng.randrange(6))]
    want = {}
    for k, _, style in sorted(rows):
        for token, multiplier in STYLE_BIAS.get(style.lower(), {}).items():
            want[k, token] = float(multiplier)
    table = L.bias_table(spark.createDataFrame(rows, "level_id BIGINT, ordinal INT, style STRING"), ["level_id"])
    assert {(r.level_id, r.token): r.multiplier for r in table.collect()} == want
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and not any("Aggregate(keys" in line and "token" in line for line in plan.splitlines())
