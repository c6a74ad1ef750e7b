"""Metrics, rules, run statistics, failures, documents and stitched layouts."""
import io
import json
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lanestride.operators import layout as P, monitor as M
from lanestride.session import stage
from lanestride.sources import writers
from lanestride.sources.wave import WaveLayout, frame_ranges, read_wave_files, samples_of, wave_layout, write_wave_files


def alerts(spark, metrics, rules=None, mode="assisted"):
    rows = M.policy_alerts(metrics, rules, mode).collect()
    return {(r.run, r.code): (r.details, r.recommendation, r.action_applied) for r in rows}


def test_rules_fire_with_details(spark):
    rows = [(0, 100, 9, 0.0, 3.0, 4, False), (1, 5, 3, 0.05, 1.9, 5, True), (2, 0, 0, 0.01, 1.0, 4, None), (3, None, None, None, None, None, None)]
    metrics = spark.createDataFrame(rows, "run INT, raw_queue BIGINT, token_queue BIGINT, unknown_object_rate DOUBLE, token_entropy DOUBLE, levels_tokenized BIGINT, collapse_indicator BOOLEAN")
    got = alerts(spark, metrics.withColumn("mix", F.expr("map('HARD', 1)")))
    assert set(got) == {(0, "TOKENIZER_BACKLOG"), (1, "DATASET_STARVATION"), (1, "UNKNOWN_OBJECTS_INCREASE"), (1, "DATASET_DIVERSITY_LOW"), (1, "TOKEN_COLLAPSE_WARNING")}
    assert got[1, "DATASET_STARVATION"] == ({"raw_queue": 5.0, "token_queue": 3.0}, "increase tokenizer allocation and scraper throughput", False)
    assert got[1, "TOKEN_COLLAPSE_WARNING"][0] == {}
    own = spark.createDataFrame([("IDLE", [("raw_queue", "=", 0.0), ("token_queue", "<", 1.0)], ["raw_queue", "absent"], "wait")], M.RULE_SCHEMA)
    assert alerts(spark, metrics, own, "autonomous") == {(2, "IDLE"): ({"raw_queue": 0.0}, "wait", True)}
    assert M.policy_alerts(metrics, own.limit(0)).count() == 0


def test_run_counters(spark):
    log = spark.createDataFrame([("saved", 1.0, 0.0), ("saved", 2.0, 60.0), ("auto_skipped", None, 90.0), ("odd", 3.0, 120.0), (None, None, 30.0)], "outcome STRING, seconds DOUBLE, ts DOUBLE")
    r = M.run_stats(log).first()
    assert (r.requests, r.saved, r.auto_skipped, r.other, r.failed) == (3, 2, 1, 2, 0)
    assert (r.avg_response_time, r.requests_per_minute, r.levels_per_minute) == (2.0, 1.5, 1.0)
    empty = M.run_stats(log.limit(0)).first()
    assert set(M.COUNTERS) <= set(empty.asDict()) and empty.requests == empty.saved == empty.other == 0 and empty.avg_response_time == 0


def test_totals_are_counted_by_the_write(spark):
    rows = spark.createDataFrame([(1, True, 10, 5, 1), (2, False, 7, 3, None), (3, True, 4, 0, 0)], "level_id INT, accepted BOOLEAN, token_count BIGINT, object_count_raw BIGINT, unknown_object_count BIGINT")
    counted, seen = M.observed_totals(rows)
    assert stage(counted).count() == 3
    assert tuple(M.totals_row(spark, seen).first()) == (3, 2, 14, 8, 1)


def test_failures_of_all_stages(spark):
    down = spark.createDataFrame([(1, "s", "timeout", "/get", 503)], "level_id BIGINT, source STRING, error STRING, endpoint STRING, status INT")
    bad = spark.createDataFrame([(2, "zero_objects", 9)], "level_id BIGINT, reason STRING, extra INT")
    rows = sorted(map(tuple, M.failures(download=down, validation=bad).collect()))
    assert rows == [("download", 1, "s", None, "timeout", "/get", 503, None), ("validation", 2, None, "zero_objects", None, None, None, None)]


def test_document_is_replaced_whole(spark, tmp_path):
    path = tmp_path / "state" / "doc.json"
    write = lambda rows, **how: writers.write_document(rows, str(path), **how)
    write(spark.createDataFrame([(1, None, "é")], "b INT, a STRING, c STRING"), indent=2)
    assert path.read_text() == json.dumps({"a": None, "b": 1, "c": "é"}, indent=2, sort_keys=True, ensure_ascii=False)
    for wrong in (spark.range(0), spark.range(2)):
        with pytest.raises(ValueError):
            write(wrong)
    broken = spark.range(1).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception):  # noqa: B017
        write(broken)
    assert json.loads(path.read_text())["b"] == 1 and [p.name for p in path.parent.iterdir() if not p.name.endswith(".crc")] == ["doc.json"]
    write(spark.createDataFrame([(2,)], "b INT"))
    assert json.loads(path.read_text()) == {"b": 2}


def test_stitched_strings_keep_the_first(spark):
    rng = random.Random(5)
    rows = [(n, f"1,{rng.randrange(3)},2,0,3,{rng.randrange(2)}", 15.0 * rng.randrange(6) + 0.25 * rng.randrange(2), rng.randrange(9), rng.randrange(4)) for n in range(200)]
    frame = spark.createDataFrame(rows, "sequence BIGINT, raw STRING, x DOUBLE, x_step BIGINT, y_lane BIGINT").repartition(4)
    seen = []
    for _, raw, x, _, _ in rows:
        parts = raw.split(",")
        parts[3] = str(round(x)) if abs(x - round(x)) < 0.001 else f"{x:.3f}".rstrip("0").rstrip(".")
        if ",".join(parts) not in seen:
            seen.append(",".join(parts))
    got = P.stitched_layout(frame, "head").first()
    assert tuple(got) == ("head;" + ";".join(seen) + ";", len(seen), max(r[3] for r in rows) + 1, max(r[4] for r in rows) + 1)
    assert tuple(P.stitched_layout(frame.limit(0), "head").first()) == ("head;", 0, 1, 1)


# -- sound files -----------------------------------------------------------------
def wave(chunks, form=b"RIFF"):
    body = b"".join(name + struct.pack("<I", size) + data + b"\0" * (len(data) & 1) for name, size, data in chunks)
    return form + struct.pack("<I", len(body) + 4) + b"WAVE" + body


FORMAT = (b"fmt ", 16, struct.pack("<HHIIHH", 1, 2, 8000, 32000, 4, 16))


class Sparse(io.RawIOBase):
    """A file of a given length with a few bytes in it, so that the planner meets lengths no test could write."""

    def __init__(self, parts):
        self.parts, self.at = parts, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = bytes(n)
        for begin, data in self.parts:
            for i, byte in enumerate(data):
                if 0 <= begin + i - self.at < n:
                    out = out[:begin + i - self.at] + bytes([byte]) + out[begin + i - self.at + 1:]
        self.at += n
        return out


def test_layout_of_headers():
    data = wave([(b"LIST", 3, b"abc"), FORMAT, (b"data", 10, b"0123456789")])
    assert wave_layout(pa.BufferReader(data), len(data)) == WaveLayout(2, 8000, 2, len(data) - 10, 2)
    cut = data[:-4]
    assert wave_layout(pa.BufferReader(cut), len(cut)).frames == 1
    for bad in (b"", b"RIFFxxxxWAV", wave([FORMAT]), wave([(b"data", 4, b"0123")]), b"X" * 60):
        assert wave_layout(pa.BufferReader(bad), len(bad)) is None


def test_a_file_of_many_gigabytes_is_cut_into_ranges():
    head = wave([(b"ds64", 28, struct.pack("<QQQI", 0, 5 << 30, 0, 0)), FORMAT], b"RF64")
    start = len(head) + 8
    length = start + (5 << 30)
    found = wave_layout(Sparse([(0, head), (len(head), b"data\xff\xff\xff\xff")]), length)
    assert found == WaveLayout(2, 8000, 2, start, (5 << 30) // 4)
    ranges = frame_ranges(found, 32 << 20)
    assert len(ranges) == 160 and ranges[0][0] == 0 and ranges[-1][1] == found.frames and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_ranges_of_a_file_give_its_samples(spark, tmp_path):
    rng = np.random.default_rng(3)
    want = {}
    for name, width, channels in (("a", 1, 1), ("b", 2, 2), ("c", 4, 3)):
        raw = rng.integers(0, 256, 997 * width * channels).astype("u1").tobytes()
        form = (b"fmt ", 16, struct.pack("<HHIIHH", 1, channels, 100, 0, 0, width * 8))
        (tmp_path / f"{name}.wav").write_bytes(wave([form, (b"data", len(raw), raw)]))
        want[f"{name}.wav"] = samples_of(raw, channels, width).tolist()
    (tmp_path / "none.wav").write_bytes(wave([FORMAT, (b"data", 0, b"")]))
    (tmp_path / "bad.wav").write_bytes(b"no sound")
    got = {}
    for r in read_wave_files(spark, str(tmp_path), split_bytes=64).orderBy("track", "idx").collect():
        got.setdefault(r.track, []).append(r.sample)
    assert got == want
    rows = spark.createDataFrame([("t", i, v) for i, v in enumerate((-2.0, -0.5, 0.0, 0.25, 1.0))], "track STRING, idx BIGINT, sample DOUBLE")
    assert [tuple(r) for r in write_wave_files(rows, str(tmp_path / "out")).collect()] == [("t", 5)]
    assert [r.sample for r in read_wave_files(spark, str(tmp_path / "out")).orderBy("idx").collect()] == [-1.0, -0.5, 0.0, 0.25, 32767 / 32768]
