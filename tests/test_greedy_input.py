"""Greedy selection runs what is behind its rows once, not in each branch that reads them."""
from __future__ import annotations

from collections import defaultdict

from lanestride.dims import DEFAULT
from lanestride.operators.greedy import min_gap
from lanestride.operators.layout import CONTROL_SPACING, control_spacing


def counted(rows, seen):
    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema)


def kept_by_force(places, gap):
    last, out = None, []
    for at in sorted(set(places)):
        if last is None or at - last >= gap:
            last = at
            out.append(at)
    return out


def test_min_gap_computes_its_rows_once(spark):
    data = [(k, (i * 37 + k * 11) % 900) for k in range(3) for i in range(200)]
    seen = spark.sparkContext.accumulator(0)
    got = defaultdict(list)
    for k, at in min_gap(counted(spark.createDataFrame(data, "k long, at long"), seen), ["k"], "at", 8, chunk=16).collect():
        got[k].append(at)
    assert {k: sorted(v) for k, v in got.items()} == {k: kept_by_force([a for i, a in data if i == k], 8) for k in range(3)}
    assert seen.value == len(data)


def test_control_spacing_computes_the_objects_once(spark):
    tokens = sorted(DEFAULT.control)
    data = [(level, i, tokens[(i * 7 + level) % len(tokens)], (i * 5 + level) // 3) for level in range(4) for i in range(150)]
    seen = spark.sparkContext.accumulator(0)
    got = control_spacing(counted(spark.createDataFrame(data, "level_id long, sequence long, token string, x_step long"), seen)).collect()
    kind = lambda t: "portal" if t in DEFAULT.portals else "gravity" if t in DEFAULT.gravity else "speed"
    first = {}
    for level, i, token, step in data:
        first.setdefault((level, kind(token), step), (token, i))
    want = []
    for level, category in {(level, category) for level, category, _ in first}:
        for step in kept_by_force([s for lv, c, s in first if (lv, c) == (level, category)], CONTROL_SPACING):
            want.append((level, category, step, *first[level, category, step]))
    assert sorted((r.level_id, r.category, r.x_step, r.token, r.sequence) for r in got) == sorted(want)
    assert seen.value == len(data)
