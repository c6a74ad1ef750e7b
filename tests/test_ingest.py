"""Raw responses, payloads, sources, sinks and streaming."""
import base64
import gzip
import json

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lanestride.operators import decompose as R, emit as E, monitor as M
from lanestride.sources import readers, writers
from lanestride.streaming.alerts import cooldown_stream, first_seen_stream
from lanestride.streaming.ingest import LEVEL_SCHEMA, STATS, TOTALS, Stage, start_ingest

SEARCH = "1:7071:2:Harbor Run:5:3:6:88:8:10:9:30:10:250:12:2:14:31:15:2:17:0:18:4:25::35:4411#88:Mira:19#1~|~4411~|~2~|~Low Tide~|~4~|~Okapi#3:20:10#tail"
LEVEL = "kA2,1;1,40,2,45,3,15;1,40,2,75,3,15;1,39,2,165,3,75,6,180;1,84,2,165,3,135;1,47,2,255,3,105"


def pack(text):
    return base64.urlsafe_b64encode(gzip.compress(text.encode())).decode().rstrip("=")


def raw(spark, *texts):
    return spark.createDataFrame([(i, "src", 0, t) for i, t in enumerate(texts)], "request_id BIGINT, source STRING, page INT, raw STRING")


def test_search_response(spark):
    rows = raw(spark, SEARCH, "-1", "")
    got = R.candidates(R.explode_search(rows)).collect()
    assert len(got) == 1
    c = got[0]
    assert (c.level_id, c.author, c.account_id, c.difficulty, c.song_id, c.song_type, c.length) == (7071, "Mira", 19, "HARD", 4411, "custom", "MEDIUM")
    song = R.songs(rows).first()
    assert (song.song_id, song.name, song.artist, song.parsed["2"]) == (4411, "Low Tide", "Okapi", "Low Tide")


def test_download_and_audio(spark):
    rows = raw(spark, f"1:62:2:Quay:4:{pack(LEVEL)}:12:1:35:780#d1#d2##1~|~780~|~10~|~http://song", "", " -1", "#a", "2:x#a")
    fields = R.download_fields(rows)
    assert [r.reason for r in fields.orderBy("request_id").collect()] == [
        None, "empty_response", "not_found_response", "missing_level_object", "missing_level_id"]
    a = R.audio_metadata(fields.where("reason IS NULL")).first()
    assert a.conditioning_ready and a.hash1 == "d1" and a.song.download_url == "http://song"


def test_demon_and_comments(spark):
    rows = raw(spark, "1:9:17:1:43:6").withColumn("p", __import__("lanestride.functions.columns", fromlist=["pairs"]).pairs("raw", ":"))
    assert rows.select(R.difficulty_label()).first()[0] == "EXTREME_DEMON"
    c = R.comments(raw(spark, "2~well met~3~88#5:10:20")).first()
    assert c.comment_count == 1 and tuple(c.page_info) == (5, 10, 20)


def test_payload_reasons(spark):
    def check(text):
        frame = spark.createDataFrame([(1, text)], "level_id BIGINT, level_data STRING")
        return R.validate_payload(R.decode_payload(frame, "level_data"), "level_data").first()
    assert check("not-valid").reason == "base64_decode_failed"
    assert check("").reason == "level_data_missing"
    assert check(base64.b64encode(b"plain").decode()).reason == "zlib_decode_failed"
    assert check(base64.b64encode(gzip.compress(b"\xff\xfe")).decode()).reason == "unicode_decode_failed"
    assert check(pack("kA2,1; ;")).reason == "zero_objects"
    ok = check(pack("kA2,1;1,40,2,45;1,39,2,75"))
    assert ok.reason is None and ok.object_count == 2


def test_object_parse(spark):
    frame = spark.createDataFrame([(1, "kA2,1;1,39,2,165,3,75,6,180;1,84,2,165,3,135;;1,,2,3;1,9,1,39,2,a;1,5,2,nan,3,1")], "level_id BIGINT, decoded STRING")
    got = R.explode_objects(frame).orderBy("seq").collect()
    assert [(r.object_id, r.x, r.y, r.rotation, r.scale) for r in got] == [(39, 165.0, 75.0, 180.0, 1.0), (84, 165.0, 135.0, 0.0, 1.0), (39, 0.0, 0.0, 0.0, 1.0)]


def test_name_filter(spark):
    names = spark.createDataFrame([("Quiet Harbor II",), ("HARBOR lights",), ("Long Pier",)], "n STRING")
    assert names.where(R.name_contains_all(F.col("n"), ["harbor"])).count() == 2
    assert names.where(R.name_contains_all(F.col("n"), [])).count() == 3


def test_readers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"level_id": "5"}\n\nnot json\n[1]\n{"level_id": "x"}\n{"level_id": 7}\n')
    assert sorted(r[0] for r in readers.read_ids_json(spark, str(tmp_path / "a.jsonl"), "level_id").collect()) == [5, 7]
    (tmp_path / "ids.txt").write_text("1\n 2 \nx\n\n1\n")
    assert sorted(r[0] for r in readers.read_ids_text(spark, str(tmp_path / "ids.txt")).collect()) == [1, 2]
    schema = StructType([StructField("a", LongType())])
    (tmp_path / "doc.json").write_text('{\n "a": 4\n}')
    (tmp_path / "broken.json").write_text('{"a": ')
    assert readers.read_document(spark, str(tmp_path / "doc.json"), schema).first().a == 4
    assert readers.read_document(spark, str(tmp_path / "broken.json"), schema).count() == 0
    frame = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    writers.write_records(frame, str(tmp_path / "out"))
    writers.write_records(frame, str(tmp_path / "out"))
    assert readers.read_records(spark, str(tmp_path / "out"), frame.schema).count() == 2


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, "a"), (2, False, "b"), (3, True, "c")], "level_id BIGINT, accepted BOOLEAN, tokens STRING")
    writers.write_routed(rows, {"kept": (F.col("accepted"), ["level_id", "tokens"]), "all": (F.lit(True), ["level_id", "accepted"])}, str(tmp_path / "r"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "r" / "kept")).collect()) == [(1, "a"), (3, "c")]
    assert spark.read.parquet(str(tmp_path / "r" / "all")).columns == ["level_id", "accepted"]
    for value in (4, 5):
        writers.write_document(spark.createDataFrame([(value,)], "a BIGINT"), str(tmp_path / "doc"))
    assert [r.a for r in spark.read.json(str(tmp_path / "doc")).collect()] == [5]


def test_level_files(spark, tmp_path):
    (tmp_path / "one.gmd").write_text(f"<dict><k>k2</k><s>n</s><k>k4</k><s>{pack(LEVEL)}==</s></dict>")
    (tmp_path / "two.gmd").write_text("h;1,8,2,3,3,4;x")
    from lanestride.operators.layout import parse_reference_objects
    got = parse_reference_objects(readers.read_level_files(spark, str(tmp_path))).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {"one.gmd": 5, "two.gmd": 1}


# -- streaming -----------------------------------------------------------------
def level_json(i, text, order):
    return json.dumps({"level_id": i, "difficulty": "hard", "source": "s", "level_data": text, "ingest_order": order}) + "\n"


def run(spark, root, files, name, per=100):
    src = root / name / "in"
    src.mkdir(parents=True, exist_ok=True)
    for n, text in files.items():
        (src / n).write_text(text)
    stage = Stage(str(root / name / "stage"))
    start_ingest(spark, str(src), stage, str(root / name / "ckpt"), limits=E.Limits(min_gameplay_objects=1, min_tokens=1), files_per_trigger=per).awaitTermination()
    return stage


def snapshot(spark, stage):
    stats = sorted((r.level_id, r.accepted, r.reason or "", r.token_count or 0) for r in stage.read(spark, "stats", STATS).collect())
    voc = stage.read(spark, "vocabulary", "token_id BIGINT, token STRING, count BIGINT, batch_id BIGINT")
    last = voc.agg(F.max("batch_id")).first()[0]
    counts = {r.token: r["count"] for r in voc.where(F.col("batch_id") == last).collect()}
    return stats, {k: v for k, v in counts.items() if v}


def test_ingest_batches_agree_and_reruns_add_nothing(spark, tmp_path):
    files = {"a.json": level_json(1, pack(LEVEL), 1) + level_json(1, pack(LEVEL), 2) + level_json(0, pack(LEVEL), 3),
             "b.json": level_json(2, "not-valid", 4) + level_json(1, pack(LEVEL), 5)}
    one, two = run(spark, tmp_path, files, "one"), run(spark, tmp_path, files, "two", per=1)
    first = snapshot(spark, one)
    assert first == snapshot(spark, two)
    assert [(s[0], s[1], s[2]) for s in first[0]] == [(1, True, ""), (2, False, "base64_decode_failed")]
    assert first[1]["PLATFORM"] == 1
    assert snapshot(spark, run(spark, tmp_path, {}, "one")) == first


def test_vocabulary_grows_in_order_of_arrival(spark, tmp_path):
    from lanestride.streaming.ingest import VOCABULARY, process_batch
    stage = Stage(str(tmp_path / "stage"))
    late, early = "h;1,88,2,45,3,15;1,88,2,165,3,75", "h;1,36,2,45,3,15;1,40,2,75,3,15"
    batch = spark.createDataFrame([(1, "hard", 0, "", "s", pack(late), 9), (2, "hard", 0, "", "s", pack(early), 3)], LEVEL_SCHEMA)
    for number in range(3):
        process_batch(batch, number, stage, limits=E.Limits(min_gameplay_objects=1, min_tokens=1))
    rows = stage.read(spark, "vocabulary", VOCABULARY).collect()
    assert {r.batch_id for r in rows} == {1, 2}
    assert {r.token: r["count"] for r in rows if r.batch_id == 2}["SAW"] == 2
    assert stage.read(spark, "parsed", "level_id BIGINT, decoded STRING, batch_id BIGINT").count() == 2


def test_replayed_batch_adds_nothing(spark, tmp_path):
    from lanestride.streaming.ingest import process_batch
    stage = Stage(str(tmp_path / "stage"))
    batch = spark.createDataFrame([(1, "hard", 0, "", "s", pack(LEVEL), 1)], LEVEL_SCHEMA)
    limits = E.Limits(min_gameplay_objects=1, min_tokens=1)
    process_batch(batch, 0, stage, limits=limits)
    before = snapshot(spark, stage)
    process_batch(batch, 0, stage, limits=limits)
    assert snapshot(spark, stage) == before
    process_batch(batch, 1, stage, limits=limits)
    assert snapshot(spark, stage) == before


def test_alert_cooldown_stream(spark, tmp_path):
    src = tmp_path / "alerts"
    rows = [("A", t * 200) for t in range(1, 11)] + [("B", 5)]
    spark.createDataFrame(rows[:6], "code STRING, ts BIGINT").coalesce(1).write.json(str(src), mode="append")
    spark.createDataFrame(rows[6:], "code STRING, ts BIGINT").coalesce(1).write.json(str(src), mode="append")
    stream = spark.readStream.schema("code STRING, ts BIGINT").option("maxFilesPerTrigger", 10).json(str(src))
    q = cooldown_stream(stream, 300).writeStream.format("memory").queryName("cool").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table("cool").collect())
    batch = sorted(tuple(r) for r in M.alert_cooldown(spark.createDataFrame(rows, "code STRING, ts BIGINT"), 300).collect())
    assert got == batch == [("A", 200), ("A", 600), ("A", 1000), ("A", 1400), ("A", 1800), ("B", 5)]


def cooldown_by_force(batches, seconds, delay):
    """Rows that are more than ``delay`` behind what earlier batches showed are late; the others take part in order."""
    newest, late, good = {}, [], {}
    for rows in batches:
        for code, ts in rows:
            (late.append((code, ts)) if ts < newest.get(code, -10 ** 9) - delay else good.setdefault(code, []).append(ts))
        for code, ts in rows:
            newest[code] = max(newest.get(code, -10 ** 9), ts)
    kept = []
    for code, times in good.items():
        last = None
        for ts in sorted(set(times)):
            if last is None or ts - last >= seconds:
                kept.append((code, ts))
                last = ts
    return kept, late, newest


def test_cooldown_takes_rows_out_of_order_and_sets_late_ones_aside(spark, tmp_path):
    import random
    from lanestride.streaming.alerts import start_cooldown
    rng = random.Random(4)
    for delay in (0, 120):
        batches = [[("A", t * 100 + rng.randrange(-300, 300)) for t in range(5 * b, 5 * b + 5) for _ in range(2)] + [("B", 50 * b)] * 2 for b in range(6)]
        batches.append([("A", 50), ("B", 0), ("A", 100_000), ("B", 100_000), (None, 3), ("C", None)])
        kept, late, newest = cooldown_by_force([[r for r in b if None not in r] for b in batches], 300, delay)
        src, root = tmp_path / f"in{delay}", tmp_path / f"out{delay}"
        for rows in batches:
            spark.createDataFrame(rows, "code STRING, ts BIGINT").coalesce(1).write.json(str(src), mode="append")
            stream = spark.readStream.schema("code STRING, ts BIGINT").json(str(src))
            start_cooldown(stream, str(root), str(tmp_path / f"c{delay}"), 300, delay).awaitTermination()
        got = [(r.code, r.ts) for r in spark.read.parquet(str(root / "alerts")).collect()]
        waits = {(c, t) for c, t in kept if t > newest[c] - delay}
        assert sorted(got) == sorted(set(kept) - waits) and len(late) > 3 and len(kept) > 8
        assert sorted((r.code, r.ts) for r in spark.read.parquet(str(root / "late_alerts")).collect()) == sorted(late)


def test_cooldown_needs_memory_for_its_length(spark):
    import pytest
    with pytest.raises(ValueError):
        cooldown_stream(None, 300, idle_seconds=10)


# -- growing files ----------------------------------------------------------------
def tailed(spark, src, root, name, rows, **options):
    """Drain what a growing source has into a table, once."""
    stream = rows(spark, str(src), **options)
    stream.writeStream.format("parquet").option("path", str(root / name)).option("checkpointLocation", str(root / f"{name}-c")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(root / name))


def test_tail_of_a_growing_and_a_truncated_file(spark, tmp_path):
    from lanestride.sources.tail import tail_lines
    src = tmp_path / "logs"
    src.mkdir()
    log, lines = src / "a.log", lambda rows: sorted((r.file.rsplit("/", 1)[-1], r.position, r.value) for r in rows.collect())
    log.write_bytes(b"one\n\ntwo\nunfini")
    want = [("a.log", 0, "one"), ("a.log", 4, ""), ("a.log", 5, "two")]
    assert lines(tailed(spark, src, tmp_path, "t", tail_lines)) == want
    assert lines(tailed(spark, src, tmp_path, "t", tail_lines)) == want
    with log.open("ab") as f:
        f.write("shed é\n".encode() + b"z" * 3000 + b"\nopen")
    (src / "b.log").write_bytes(b"other\n")
    (src / "_hidden").write_bytes(b"not read\n")
    want = sorted([*want, ("a.log", 9, "unfinished é"), ("a.log", 23, "z" * 3000), ("b.log", 0, "other")])
    assert lines(tailed(spark, src, tmp_path, "t", tail_lines)) == want
    log.write_bytes(b"new\nstart\nrest")
    want = sorted([*want, ("a.log", 0, "new"), ("a.log", 4, "start")])
    assert lines(tailed(spark, src, tmp_path, "t", tail_lines)) == want
    log.write_bytes(b"")
    assert lines(tailed(spark, src, tmp_path, "t", tail_lines)) == want
    assert lines(tailed(spark, log, tmp_path, "single", tail_lines)) == []


def test_byte_ranges_meet_at_lines():
    """Every line belongs to exactly one range, wherever the cuts fall."""
    import random
    import pyarrow as pa
    from lanestride.sources.tail import line_ranges, read_lines
    rng = random.Random(1)
    data = b"".join(b"x" * rng.randrange(9) + b"\n" for _ in range(60))
    begins = [0, *(i + 1 for i, c in enumerate(data) if c == 10)]
    for start in (0, begins[7]):
        for split in (1, 2, 5, 64, 10_000):
            found = []
            for part in line_ranges({"f": start}, {"f": len(data)}, split):
                for batch in read_lines(pa.BufferReader(data), part, 7):
                    found += zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            assert [f[0] for f in found] == [b for b in begins[:-1] if b >= start]
            assert b"".join(v.encode() + b"\n" for _, v in found) == data[start:]
    assert [(r.start, r.low, r.high) for r in line_ranges({"f": 90}, {"f": 8}, 5)] == [(0, 0, 5), (0, 5, 8)]


def test_ingest_of_a_growing_file_over_restarts(spark, tmp_path):
    """Ids are taken once, over batches and restarts, the first record of a batch first; the history is not read for it."""
    src = tmp_path / "levels.jsonl"
    stage = Stage(str(tmp_path / "stage"))

    def drain():
        start_ingest(spark, str(src), stage, str(tmp_path / "ckpt"), limits=E.Limits(min_gameplay_objects=1, min_tokens=1), appended=True).awaitTermination()
        return sorted((r.level_id, r.batch_id, r.reason) for r in stage.read(spark, "stats", STATS).collect())

    src.write_text(level_json(1, "not-valid", 7) + level_json(1, pack(LEVEL), 2) + level_json(2, pack(LEVEL), 3) + level_json(3, pack(LEVEL), 4)[:20])
    first = drain()
    assert [r[0] for r in first] == [1, 2] and not first[0][2]
    assert drain() == first
    with src.open("a") as f:
        f.write(level_json(3, pack(LEVEL), 4)[20:] + level_json(1, pack(LEVEL), 5) + "{broken\n\n" + level_json(-4, pack(LEVEL), 6))
    second = drain()
    assert [r[0] for r in second] == [1, 2, 3] and second[:2] == first
    src.write_text(level_json(2, pack(LEVEL), 1) + level_json(9, pack(LEVEL), 2))
    assert [r[0] for r in drain()] == [1, 2, 3, 9]
    totals = stage.read(spark, "totals", TOTALS).collect()
    assert sum(r.levels_processed for r in totals) == 4 == sum(r.levels_tokenized for r in totals) and all(r.seconds > 0 for r in totals)
    assert sum(r.tokens_tokenized for r in totals) == sum(r.token_count for r in stage.read(spark, "stats", STATS).collect())


def test_first_seen_stream(spark, tmp_path):
    src = tmp_path / "songs"
    spark.createDataFrame([(1,), (1,), (2,)], "song_id BIGINT").write.json(str(src))
    stream = spark.readStream.schema("song_id BIGINT").json(str(src))
    q = first_seen_stream(stream).writeStream.format("memory").queryName("songs").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r[0] for r in spark.table("songs").collect()) == [1, 2]


def test_files_are_written_by_many_tasks_into_one_folder(spark, tmp_path):
    from lanestride.sources.writers import write_files
    files = spark.range(0, 50, 1, 1).selectExpr("concat(id, '.txt') AS name", "CASE WHEN id = 3 THEN NULL ELSE concat('h,0;1,8,2,', id, ',3,4;') END AS content")
    for _ in range(2):
        told = {r.name: r.bytes for r in write_files(files, str(tmp_path / "in")).collect()}
    assert sorted(p.name for p in (tmp_path / "in").iterdir()) == sorted(told) == sorted(f"{i}.txt" for i in range(50))
    assert told["3.txt"] == 0 and (tmp_path / "in" / "12.txt").read_text() == "h,0;1,8,2,12,3,4;"
    assert write_files(files, str(tmp_path / "in")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    from lanestride.operators.layout import parse_reference_objects
    got = parse_reference_objects(readers.read_level_files(spark, str(tmp_path / "in"), "*.txt")).collect()
    assert sorted(r.x for r in got) == [float(i) for i in range(50) if i != 3]


def test_level_files_of_the_query_lie_in_one_folder(spark):
    import os
    from lanestride import session
    from lanestride.plans.registry import QUERIES
    found = QUERIES["read_level_files"](spark, "/root/testdata/sf0.001")
    path = session._STAGED[spark.sparkContext.applicationId][-1]
    names = os.listdir(path)
    assert found.count() == 2 * len(names) and all(n.endswith(".txt") and os.path.isfile(f"{path}/{n}") for n in names)


def test_level_records_meet_their_candidates_in_the_only_join(spark):
    from lanestride.plans.registry import QUERIES
    plan = QUERIES["level_record"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "inflate" not in plan
    side = plan[plan.index("Join "):].splitlines()[1]  # what the downloads send: fields of the record, not their pairs
    assert side.lstrip(" :+-").startswith("Project") and " p#" not in side and "raw#" not in side.split(" AS ")[-1]


def test_payload_counts_keep_the_reason_of_the_download(spark):
    from lanestride.operators import decompose as R
    import base64, gzip
    packed = base64.urlsafe_b64encode(gzip.compress(b"h;1,8;1,9")).decode().rstrip("=")
    raw = spark.createDataFrame([(1, f"1:7:4:{packed}#a#b"), (2, "1:8#a#b"), (3, "-1")], "request_id BIGINT, raw STRING")
    got = {r.request_id: (r.reason, r.object_count, r.decoded_length) for r in R.payload_counts(R.download_fields(raw)).collect()}
    assert got == {1: (None, 2, 9), 2: (None, 0, 0), 3: ("not_found_response", 0, 0)}
