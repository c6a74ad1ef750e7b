"""Registered queries: raw responses, payloads, ingestion bookkeeping, monitoring."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lanestride.functions.columns import pairs, pairs_map
from lanestride.operators import analytics as A, decompose as R, monitor as M, ngram as N, objects as O
from lanestride.plans import bindings as B
from lanestride.plans.catalog_tokens import stats
from lanestride.plans.oracle import gap_sql, sql
from lanestride.session import stage
from lanestride.sources.readers import parse_records

QUERIES: dict = {}
SQL: dict[str, str] = {}


def register(name: str, text: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if text is not None:
            SQL[name] = text
        return fn
    return add


more = lambda *names: sql("", *names).rstrip() + ", "
# Direct forms of the fields that the raw text encodes.
RID = "l_orderkey * 8 + l_linenumber"
DIFF = """CASE WHEN l_partkey % 11 = 0 THEN 'AUTO' WHEN l_returnflag = 'R' THEN CASE l_partkey % 8 WHEN 3 THEN 'EASY_DEMON' WHEN 4 THEN 'MEDIUM_DEMON' WHEN 5 THEN 'INSANE_DEMON' WHEN 6 THEN 'EXTREME_DEMON' ELSE 'HARD_DEMON' END
  WHEN l_linenumber = 3 THEN 'NA' ELSE CASE l_suppkey % 7 WHEN 1 THEN 'EASY' WHEN 2 THEN 'NORMAL' WHEN 3 THEN 'HARD' WHEN 4 THEN 'HARDER' WHEN 5 THEN 'INSANE' ELSE 'NA' END END"""
LENGTH = "CASE l_linenumber WHEN 1 THEN 'SHORT' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LONG' WHEN 4 THEN 'XL' WHEN 5 THEN 'PLATFORMER' ELSE 'UNKNOWN' END"
SONG = "CASE WHEN l_partkey % 3 = 0 AND l_partkey > 0 THEN l_partkey ELSE l_suppkey % 20 + 1 END"
STYPE = "CASE WHEN l_partkey % 3 = 0 AND l_partkey > 0 THEN 'custom' ELSE 'official' END"
NAME = "'Part ' || l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN ' Layout' ELSE ' remake' END"
CAND = f"""cand AS (SELECT {RID} AS request_id, {RID} AS level_id, l_suppkey AS player_id, {NAME} AS name, 'Supplier' || l_suppkey AS author, l_suppkey * 3 AS account_id, {DIFF} AS difficulty,
  CAST(l_quantity AS BIGINT) AS downloads, CAST(0 AS BIGINT) AS likes, {LENGTH} AS length, {SONG} AS song_id, {STYPE} AS song_type, CAST(l_linenumber AS BIGINT) AS version, l_partkey % 11 = 0 AS is_auto, l_linestatus AS source, l_linenumber AS page FROM ol)"""

search = lambda s, d: R.explode_search(B.search_responses(s, d))
candidates = lambda s, d: R.candidates(search(s, d))
register("kv_pairs", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'a=' || CASE WHEN o_orderkey % 3 = 1 THEN o_custkey ELSE 9 END || ' b=' || o_orderstatus END AS kv FROM orders""")(
    lambda s, d: B.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr(
        "CASE o_orderkey % 3 WHEN 0 THEN 'alone' WHEN 1 THEN concat('a~|~', o_custkey, '~|~b~|~', o_orderstatus, '~|~tail') ELSE concat('a~|~', o_custkey, '~|~b~|~', o_orderstatus, '~|~a~|~9') END").alias("raw"))
    .withColumn("p", pairs("raw", "~|~")).withColumn("m", pairs_map("p"))
    .select("id", F.expr("array_join(transform(array_sort(map_entries(m)), e -> concat(e.key, '=', e.value)), ' ')").alias("kv")))
register("search_levels", sql(f"SELECT {RID} AS request_id, {RID} AS level_id, CAST(0 AS BIGINT) AS pos FROM ol UNION ALL SELECT {RID}, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM ol", "ol"))(
    lambda s, d: search(s, d).select("request_id", R.num("p", "1").alias("level_id"), F.col("pos").cast("bigint").alias("pos")))
register("creators", sql(f"SELECT {RID} AS request_id, l_suppkey AS player_id, 'Supplier' || l_suppkey AS username, l_suppkey * 3 AS account_id FROM ol", "ol"))(
    lambda s, d: R.creators(B.search_responses(s, d)))
register("songs", sql(f"SELECT {RID} AS request_id, CAST(0 AS BIGINT) AS pos, l_partkey AS song_id, 'Song ' || l_partkey AS name, 'Artist' AS artist, '1.5' AS size, CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE 'http://x/y' END AS download_url FROM ol WHERE l_partkey > 0 UNION ALL SELECT {RID}, CAST(1 AS BIGINT), CAST(7 AS BIGINT), 'Extra', '', '', '' FROM ol", "ol"))(
    lambda s, d: R.songs(B.search_responses(s, d)).drop("raw_song", "parsed").withColumn("pos", F.col("pos").cast("bigint")))
register("page_info", sql(f"SELECT {RID} AS request_id, CAST(l_quantity AS BIGINT) AS total, CAST(l_linenumber AS BIGINT) AS \"offset\", CAST(10 AS BIGINT) AS amount FROM ol", "ol"))(
    lambda s, d: B.search_responses(s, d).select("request_id", R.page_info(R.section("raw", 3)).alias("i")).select("request_id", "i.*"))
register("level_labels", sql(f"SELECT {RID} AS level_id, {DIFF} AS difficulty, {LENGTH} AS length, {SONG} AS song_id, {STYPE} AS song_type, l_partkey % 11 = 0 AS is_auto FROM ol UNION ALL SELECT CAST(0 AS BIGINT), 'NA', 'TINY', CAST(1 AS BIGINT), 'official', false FROM ol", "ol"))(
    lambda s, d: search(s, d).select(R.num("p", "1").alias("level_id"), R.difficulty_label().alias("difficulty"), R.length_label().alias("length"),
                                                     R.song_id().alias("song_id"), R.song_type().alias("song_type"), R.is_auto().alias("is_auto")))
CC = ["level_id", "player_id", "name", "author", "account_id", "difficulty", "downloads", "likes", "length", "song_id", "song_type", "version"]
register("candidates", more("ol") + CAND + f" SELECT {', '.join(CC)} FROM cand")(lambda s, d: candidates(s, d).select(*CC))
register("name_filter", more("ol") + CAND + " SELECT level_id, name FROM cand WHERE lower(name) LIKE '%layout%' AND lower(name) LIKE '%part 1%'")(
    lambda s, d: candidates(s, d).where(R.name_contains_all(F.col("name"), ["layOut", "PART 1"])).select("level_id", "name"))
DOWN = f"""down AS (SELECT {RID} AS request_id, *, CASE WHEN l_linenumber = 6 THEN 'empty_response' WHEN l_linenumber = 7 THEN 'not_found_response' WHEN l_linenumber = 5 THEN 'missing_level_object' WHEN l_partkey % 13 = 0 THEN 'missing_level_id' END AS reason,
  CASE l_suppkey % 7 WHEN 1 THEN 'EASY' WHEN 2 THEN 'NORMAL' WHEN 3 THEN 'HARD' WHEN 4 THEN 'HARDER' WHEN 5 THEN 'INSANE' ELSE 'NA' END AS difficulty, {SONG} AS song_id, {STYPE} AS song_type FROM ol),
 aud AS (SELECT *, song_id = l_partkey AS has, song_type = 'custom' AND song_id = l_partkey AND l_suppkey % 4 <> 0 AS ready FROM down WHERE reason IS NULL)"""
down = lambda s, d: R.download_fields(B.download_responses(s, d))
audio = lambda s, d: R.audio_metadata(down(s, d).where("reason IS NULL"))
register("download_fields", more("ol") + DOWN + " SELECT request_id, reason, CASE WHEN reason IS NULL THEN 'h' || l_orderkey WHEN reason LIKE 'missing%' THEN 'h' ELSE '' END AS hash1 FROM down")(
    lambda s, d: down(s, d).select("request_id", "reason", "hash1"))
register("audio_record", more("ol") + CAND + ", " + DOWN + " SELECT aud.request_id AS level_id, aud.song_id, aud.song_type, cand.source, cand.page AS source_page, has AS has_custom_song_metadata, ready AS conditioning_ready, CASE WHEN has THEN CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'set' END END AS url FROM aud JOIN cand ON cand.level_id = aud.request_id")(
    lambda s, d: R.audio_records(audio(s, d), candidates(s, d)).select("level_id", "song_id", "song_type", "source", "source_page", "audio.has_custom_song_metadata", "audio.conditioning_ready",
                                                                       F.when(F.col("audio.song.download_url") == "", "").when(F.col("audio.song.download_url").isNotNull(), "set").alias("url")))
register("level_record", more("ol") + CAND + ", " + DOWN + """ SELECT request_id AS level_id, CASE WHEN l_partkey % 2 = 0 THEN 'Name ' || l_partkey ELSE cand.name END AS name, CASE WHEN l_suppkey % 2 = 0 THEN 'User' || l_suppkey ELSE cand.author END AS author,
  aud.difficulty, CAST(l_quantity AS BIGINT) AS downloads, aud.song_id, aud.song_type, ready AS conditioning_ready, 'h' || l_orderkey AS level_hash, 'g' || l_partkey AS download_hash2, cand.account_id, 'ZGVzYw' AS description_b64, cand.length, cand.source, cand.page AS source_page,
  cand.difficulty AS search_difficulty, cand.downloads AS search_downloads, cand.likes AS search_likes, cand.length AS search_length, cand.version AS search_version, cand.song_id AS search_song_id, cand.song_type AS search_song_type FROM aud JOIN cand USING (request_id)""")(
    lambda s, d: R.level_records(R.payload_counts(audio(s, d)), candidates(s, d).withColumn("sequence", F.lit(0))).select(
        "level_id", "name", "author", "difficulty", "downloads", "song_id", "song_type", "audio.conditioning_ready", "level_hash", "metadata.download_hash2", "metadata.account_id",
        "metadata.description_b64", "metadata.length", "source", "source_page",
        *[F.col(f"metadata.search.{f}").alias(f"search_{f}") for f in ("difficulty", "downloads", "likes", "length", "version", "song_id", "song_type")]))
register("reject_rows", more("ol") + DOWN + " SELECT request_id AS level_id, reason, reason AS detail, CAST(0 AS INT) AS candidate_sequence, l_linestatus AS source, l_linenumber AS source_page, 'validation' AS stage FROM down WHERE reason IS NOT NULL")(
    lambda s, d: M.rejects(candidates(s, d).withColumn("sequence", F.lit(0)), down(s, d).where("reason IS NOT NULL").select(F.col("request_id").alias("level_id"), "reason", F.col("reason").alias("detail"))))
register("comments", """WITH r AS (SELECT doc_id, n_chars, CASE WHEN doc_id % 10 = 3 THEN '-1' ELSE text || '#' || n_chars || ':0:10' END AS raw FROM documents),
 f AS (SELECT *, string_split(raw, '#')[1] AS body, CASE WHEN contains(raw, '#') THEN string_split(substr(raw, strpos(raw, '#') + 1), ':') ELSE [] END AS tail FROM r)
 SELECT doc_id AS request_id, CAST(doc_id % 7 AS BIGINT) AS page, CASE WHEN raw = '-1' THEN 0 ELSE len([c for c in string_split(body, '|') if c <> '']) END AS comment_count,
  CASE WHEN raw <> '-1' AND len(tail) >= 3 THEN coalesce(TRY_CAST(trim(tail[1]) AS BIGINT), 0) END AS total FROM f""")(
    lambda s, d: R.comments(B.table(s, d, "documents").select(F.col("doc_id").alias("request_id"), F.expr("doc_id % 7").alias("page"), F.expr(
        "CASE WHEN doc_id % 10 = 3 THEN '-1' ELSE concat(text, '#', n_chars, ':0:10') END").alias("raw"))).select("request_id", "page", "comment_count", F.col("page_info.total").alias("total")))

# -- payloads -----------------------------------------------------------------
payload = lambda s, d: B.table(s, d, "documents").select(F.col("doc_id").alias("level_id"), "text").withColumn("level_data", B.deflate_urlsafe("text"))
register("decode", "SELECT doc_id AS level_id, md5(text) AS digest, length(text) AS decoded_length, CAST(NULL AS VARCHAR) AS decode_reason FROM documents")(
    lambda s, d: R.decode_payload(payload(s, d), "level_data").select("level_id", F.md5("decoded").alias("digest"), F.length("decoded").cast("bigint").alias("decoded_length"), "decode_reason"))
register("validate_payload", """SELECT doc_id AS level_id, CASE WHEN doc_id % 5 IN (0, 1, 2) THEN 0 ELSE len([x for x in string_split(text, ';')[2:] if trim(x) <> '']) END AS object_count,
  CASE doc_id % 5 WHEN 0 THEN 'level_data_missing' WHEN 1 THEN 'base64_decode_failed' WHEN 2 THEN 'zlib_decode_failed' ELSE CASE WHEN len([x for x in string_split(text, ';')[2:] if trim(x) <> '']) = 0 THEN 'zero_objects' END END AS reason FROM documents""")(
    lambda s, d: R.validate_payload(R.decode_payload(payload(s, d).withColumn("level_data", F.expr(
        "CASE level_id % 5 WHEN 0 THEN '' WHEN 1 THEN concat('!', level_data) WHEN 2 THEN concat('AAAA', level_data) ELSE level_data END")), "level_data"), "level_data").select("level_id", "object_count", "reason"))
register("explode_objects", sql(f"""SELECT {RID} AS level_id, CAST(1 AS BIGINT) AS seq, CAST(l_partkey % 100 AS BIGINT) AS object_id, CAST(l_quantity AS DOUBLE) AS x, CAST(l_linenumber AS DOUBLE) AS y, 9e1 AS rotation, 1e0 AS scale FROM ol WHERE l_partkey % 100 > 0
  UNION ALL SELECT {RID}, 4, l_suppkey, 0, l_tax, 0, 25e-1 FROM ol UNION ALL SELECT {RID}, 5, CAST(l_linenumber AS BIGINT), l_discount, 0, 0, 1 FROM ol""", "ol"))(
    lambda s, d: R.explode_objects(B.level_texts(s, d)))

# -- keys and queues ----------------------------------------------------------
register("parse_records", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")(
    lambda s, d: parse_records(B.table(s, d, "events"), "props", "k BIGINT", ("event_id",)))
register("latest_by_key", "SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) AS r FROM lineitem) WHERE r = 1")(
    lambda s, d: M.latest_by_key(B.table(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.struct("l_shipdate", "l_extendedprice", "l_partkey").alias("o")), "l_orderkey", "o").drop("o"))
keyed = lambda s, d: (B.table(s, d, "orders").selectExpr("o_orderkey AS level_id"), B.table(s, d, "lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey AS level_id"),
                      B.table(s, d, "lineitem").where("l_returnflag = 'N'").selectExpr("l_orderkey AS level_id"))
register("unseen", "SELECT o_orderkey AS level_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('R', 'N'))")(lambda s, d: M.unseen(*keyed(s, d)))
register("unseen_retry", "SELECT o_orderkey AS level_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")(
    lambda s, d: M.unseen(*keyed(s, d)[:2], None))
register("pending_records", "SELECT o_orderkey AS level_id FROM orders WHERE o_orderkey > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('R', 'N'))")(lambda s, d: M.pending_records(*keyed(s, d)))
register("limit_input", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500")(
    lambda s, d: M.limit_input(B.table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), 500, ["o_orderdate", "o_orderkey"]).drop("o_orderdate"))
register("target_cap", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100")(
    lambda s, d: M.target_cap(B.table(s, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), 100, ["o_orderkey"]))
register("queue_sizes", "SELECT greatest((SELECT count(*) FROM orders) - (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag = 'R'), 0) AS raw_queue, greatest((SELECT count(*) FROM part) - (SELECT count(*) FROM customer), 0) AS token_queue")(
    lambda s, d: M.queue_sizes(keyed(s, d)[0], keyed(s, d)[1].distinct(), B.table(s, d, "part"), B.table(s, d, "customer")))
register("discover", more("ol") + CAND + """, ok AS (SELECT player_id AS level_id, name, source, page, request_id, CASE source WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS so FROM cand WHERE NOT is_auto AND lower(name) LIKE '%layout%'
   AND player_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 = 0) AND player_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 9 = 0)),
 f AS (SELECT *, row_number() OVER (PARTITION BY level_id ORDER BY so, page, request_id) AS r FROM ok) SELECT level_id, name, source, 500 + row_number() OVER (ORDER BY so, page, request_id) - 1 AS sequence FROM f WHERE r = 1""")(
    lambda s, d: M.discover(candidates(s, d).withColumn("source_order", F.expr("CASE source WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END")).withColumn("pos", F.col("request_id")).withColumn("level_id", F.col("player_id")),
                            B.table(s, d, "supplier").where("s_suppkey % 4 = 0").selectExpr("s_suppkey AS level_id"), B.table(s, d, "supplier").where("s_suppkey % 9 = 0").selectExpr("s_suppkey AS level_id"),
                            R.name_contains_all(F.col("name"), ["layout"]), 500).select("level_id", "name", "source", "sequence"))
register("source_progress", "WITH p AS (SELECT o_orderpriority AS source, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS page, count(*) FILTER (o_orderstatus = 'F' AND o_custkey % 50 = 1) AS n FROM orders GROUP BY 1, 2) SELECT source, CAST(coalesce(min(CASE WHEN n = 0 THEN page END), max(page) + 1) AS BIGINT) AS next_page, bool_or(n = 0) AS done FROM p GROUP BY 1")(
    lambda s, d: M.source_progress(B.table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("source"), F.expr("CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT)").alias("page"))
                                   .agg(F.count_if(F.expr("o_orderstatus = 'F' AND o_custkey % 50 = 1")).alias("n_levels"))))
register("first_seen_songs", "SELECT l_partkey AS song_id, l_orderkey AS first_order FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")(
    lambda s, d: M.first_seen_songs(B.table(s, d, "lineitem").selectExpr("l_partkey AS song_id", "l_orderkey AS first_order", "l_linenumber"), F.struct("first_order", "l_linenumber")).select("song_id", "first_order"))
LOGT = "SELECT event_type AS outcome, value / 1e2 AS seconds, epoch_us(ts) / 1e6 AS ts FROM events"
log = lambda s, d: B.table(s, d, "events").select(F.col("event_type").alias("outcome"), (F.col("value") / 100).alias("seconds"), F.expr(f"{B._micros()} / 1e6D").alias("ts"))
OUTCOMES = {"click": "saved", "view": "discovered", "error": "failed", "purchase": "songs_saved"}
RUN = f"""(SELECT count(*) AS requests, {', '.join(f"count(*) FILTER (outcome = '{dict((c, o) for o, c in OUTCOMES.items()).get(c, '')}') AS {c}" for c in M.COUNTERS)},
  count(*) FILTER (outcome = 'signup') AS other, round(avg(seconds), 6) AS avg_response_time, round(count(*) / ((max(ts) - min(ts)) / 60), 6) AS requests_per_minute,
  round(count(*) FILTER (outcome = 'click') / ((max(ts) - min(ts)) / 60), 6) AS levels_per_minute FROM ({LOGT}))"""
register("run_stats", "SELECT * FROM " + RUN)(lambda s, d: M.run_stats(log(s, d), OUTCOMES))
register("failures", more("ol") + DOWN + """ SELECT CASE WHEN reason IN ('empty_response', 'not_found_response') THEN 'download' ELSE 'validation' END AS stage, request_id AS level_id, l_linestatus AS source, reason, reason AS error, CAST(NULL AS INTEGER) AS status FROM down WHERE reason IS NOT NULL""")(
    lambda s, d: (lambda bad: M.failures(download=bad.where("reason IN ('empty_response', 'not_found_response')"), validation=bad.where("reason NOT IN ('empty_response', 'not_found_response')")))(
        down(s, d).where("reason IS NOT NULL").select(F.col("request_id").alias("level_id"), "source", "reason", F.col("reason").alias("error"))).select("stage", "level_id", "source", "reason", "error", "status"))
register("alert_cooldown", "WITH " + gap_sql("(SELECT event_type AS code, epoch_us(ts) // 1000000 AS ts FROM events)", "code", "ts", "3600", "kept") + " SELECT code, ts FROM kept")(
    lambda s, d: M.alert_cooldown(B.alerts(s, d), 3600))
PLT = "lg AS (SELECT user_id % 5 AS run, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) - 1 AS step, value AS train_loss, (value * 37) % 101 AS eval_loss FROM events)"
register("plateau", "WITH " + PLT + """, h AS (SELECT *, coalesce(train_loss < lag(train_loss) OVER w - 1e-6 AND eval_loss >= lag(eval_loss) OVER w - 1e-4, false) AS hit FROM lg WINDOW w AS (PARTITION BY run ORDER BY step)),
 c AS (SELECT *, step - max(CASE WHEN NOT hit THEN step END) OVER (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING) AS n FROM h) SELECT run, step, n AS plateau_count, n >= 3 AS alert FROM c""")(
    lambda s, d: M.plateau(_losses(s, d), "run", "step").select("run", "step", "plateau_count", "alert"))


def _losses(s: SparkSession, d: str) -> DataFrame:
    from lanestride.operators.spread import ordered_index
    rows = B.table(s, d, "events").selectExpr("user_id % 5 AS run", "event_id", "value AS train_loss", "(value * 37) % 101 AS eval_loss")
    return ordered_index(rows, ["run"], F.floor(F.col("event_id") / 4096), ["event_id"], "step")


register("is_recent", "SELECT event_id, 1706659200 - epoch_us(ts) / 1e6 <= 86400 AS recent FROM events")(
    lambda s, d: B.table(s, d, "events").select("event_id", M.is_recent(F.expr(f"{B._micros()} / 1e6D"), F.lit(1706659200), 86400).alias("recent")))
register("last_n", "SELECT event_id, event_type FROM events ORDER BY ts DESC LIMIT 16")(
    lambda s, d: M.last_n(B.table(s, d, "events").select("event_id", "event_type", "ts"), 16, "ts").drop("ts"))
register("latest_record", "SELECT event_id, user_id FROM events ORDER BY ts DESC LIMIT 1")(
    lambda s, d: M.latest_record(B.table(s, d, "events").select("event_id", "user_id", "ts"), "ts").drop("ts"))
RECENT = sql("", "sgram", "stats").rstrip() + """, acc AS (SELECT * FROM stats WHERE reason = '' ORDER BY level_id DESC LIMIT 200), lastst AS (SELECT * FROM stats ORDER BY level_id DESC LIMIT 200),
 tc AS (SELECT t AS token, count(*) AS count FROM (SELECT unnest(tokens) AS t FROM acc) GROUP BY 1),
 trn AS (SELECT event_id AS step, value AS train_loss, value / 2e2 AS eval_loss, user_id AS examples FROM events WHERE event_type = 'click' ORDER BY event_id DESC LIMIT 1),
 evl AS (SELECT value / 1e3 AS diversity, value < 1e2 AS collapsed, event_id % 2 = 0 AS grammar_valid FROM events WHERE event_type = 'view' ORDER BY event_id DESC LIMIT 1),
 run AS """ + RUN + """,
 met AS (SELECT greatest((SELECT count(*) FROM orders) - (SELECT count(*) FROM stats), 0) AS raw_queue, CAST(0 AS BIGINT) AS token_queue, (SELECT round(-sum(count / t * log2(count / t)), 6) FROM tc, (SELECT sum(count) AS t FROM tc)) AS token_entropy,
  (SELECT round(avg(CASE WHEN level_id IN (SELECT level_id FROM serr) THEN 0 ELSE 1 END), 6) FROM acc) AS grammar_validity, (SELECT round(avg(len(list_filter(tokens, lambda t: t = 'STEP')) / len(tokens)), 6) FROM acc) AS avg_step_density,
  (SELECT round(sum(unknown_object_count) / sum(object_count_raw), 6) FROM lastst) AS unknown_object_rate, (SELECT CAST(sum(token_count) AS BIGINT) FROM stats WHERE reason = '') AS tokens_generated,
  (SELECT count(*) FROM stats) AS levels_processed, (SELECT count(*) FROM stats WHERE reason = '') AS levels_tokenized, (SELECT count(*) FROM stats WHERE reason = '') AS dataset_size,
  (SELECT round(sum(token_count) / (SELECT max(ts) - min(ts) FROM (""" + LOGT + """)), 6) FROM stats WHERE reason = '') AS tokens_per_second, (SELECT count(DISTINCT nullif(source, '')) FROM stats) AS source_diversity,
  (SELECT string_agg(difficulty || '=' || n, ',' ORDER BY difficulty) FROM (SELECT difficulty, count(*) AS n FROM stats GROUP BY 1)) AS difficulty_distribution,
  run.levels_per_minute, run.failed AS request_failures, run.duplicates_skipped, trn.train_loss AS training_loss, trn.eval_loss, round(1 / (1 + trn.eval_loss), 6) AS validation_quality, trn.examples AS training_queue, trn.step AS steps,
  evl.diversity AS generation_diversity, evl.collapsed AS collapse_indicator, evl.grammar_valid AS grammar_legal FROM run, trn, evl)"""


def metrics(s: SparkSession, d: str) -> DataFrame:
    counted, seen = M.observed_totals(stats(s, d))
    st = stage(counted)
    good, events = st.where("accepted"), B.table(s, d, "events")
    queues = M.queue_sizes(B.table(s, d, "orders"), st, good, good)
    training = events.where("event_type = 'click'").selectExpr("event_id AS step", "value AS train_loss", "value / 200 AS eval_loss", "user_id AS examples")
    evaluation = events.where("event_type = 'view'").selectExpr("event_id AS step", "value / 1000 AS diversity", "value < 100 AS collapsed", "event_id % 2 = 0 AS grammar_valid")
    span = log(s, d).agg((F.max("ts") - F.min("ts")).alias("_span"))
    return M.pipeline_metrics(queues.crossJoin(span), stage(N.recent_records(good, 200, "level_id")), A.unknown_rate(N.recent_records(st, 200, "level_id")),
                              A.token_counts(good), st, M.totals_row(s, seen), M.run_stats(log(s, d), OUTCOMES), training, evaluation, F.col("_span")).drop("_span")


MIX = "array_join(transform(array_sort(map_entries(difficulty_distribution)), e -> concat(e.key, '=', e.value)), ',')"
register("pipeline_metrics", RECENT + " SELECT * FROM met")(lambda s, d: metrics(s, d).withColumn("difficulty_distribution", F.expr(MIX)))
register("policy_alerts", RECENT + """, r(code, advice) AS (VALUES """ + ", ".join(f"('{code}', '{advice}')" for code, _, _, advice in M.RULES) + """)
 SELECT code, advice AS recommendation, CASE code WHEN 'TOKENIZER_BACKLOG' THEN 'raw_queue=' || CAST(raw_queue AS BIGINT) WHEN 'DATASET_STARVATION' THEN 'raw_queue=' || CAST(raw_queue AS BIGINT) || ',token_queue=' || token_queue
   WHEN 'UNKNOWN_OBJECTS_INCREASE' THEN 'unknown_object_rate=' || CAST(round(unknown_object_rate * 1e6, 0) AS BIGINT) WHEN 'DATASET_DIVERSITY_LOW' THEN 'token_entropy=' || CAST(round(token_entropy * 1e6, 0) AS BIGINT) ELSE '' END AS details, false AS action_applied
 FROM met, r WHERE CASE code WHEN 'TOKENIZER_BACKLOG' THEN raw_queue >= 100 WHEN 'DATASET_STARVATION' THEN token_queue <= 3 AND raw_queue > 0 WHEN 'UNKNOWN_OBJECTS_INCREASE' THEN unknown_object_rate >= 5e-2
   WHEN 'DATASET_DIVERSITY_LOW' THEN levels_tokenized >= 5 AND token_entropy < 2 ELSE collapse_indicator END""")(
    lambda s, d: M.policy_alerts(metrics(s, d)).select("code", "recommendation", F.expr(
        "array_join(transform(map_entries(details), e -> concat(e.key, '=', cast(round(CASE WHEN e.key IN ('raw_queue', 'token_queue') THEN e.value ELSE e.value * 1e6 END, 0) AS bigint))), ',')").alias("details"), "action_applied"))
TEL = """WITH m AS (SELECT event_id AS ts, CAST(event_id % 7 AS BIGINT) AS steps, value AS training_loss, value / 2 AS validation_loss, user_id AS dataset_size, event_id % 50 AS raw_queue, event_id % 3 AS token_queue, event_id + 1 AS scraped, value / 3 AS entropy FROM events WHERE event_type = 'click'),
 t AS (SELECT event_id AS step, CASE WHEN event_id % 2 = 0 THEN 0 ELSE value END AS train_loss, value AS eval_loss FROM events WHERE event_type = 'view'), e AS (SELECT event_id AS step, value AS diversity FROM events WHERE event_type <> 'view')
 SELECT m.ts AS heartbeat, coalesce(nullif(t.step, 0), m.steps) AS step, CAST(greatest(1, floor(coalesce(nullif(t.step, 0), m.steps) / 10000) + 1) AS BIGINT) AS epoch, round(dataset_size / greatest(dataset_size + raw_queue + token_queue, 1) * 100, 6) AS progress_pct,
  round(coalesce(nullif(train_loss, 0), training_loss, 0), 6) AS loss, round(coalesce(nullif(eval_loss, 0), validation_loss), 6) AS val_loss, round(diversity, 6) AS generation_diversity, raw_queue, token_queue, dataset_size,
  CAST(0 AS DOUBLE) AS tokens_per_second, CAST(0 AS INT) AS training_queue, m.scraped AS levels_scraped, CAST(0 AS INT) AS tokens_generated, round(m.entropy, 6) AS token_entropy, CAST(0 AS DOUBLE) AS grammar_validity,
  (SELECT event_type FROM events ORDER BY event_id DESC LIMIT 1) AS event, '' AS sample_preview, CAST(67 AS BIGINT) AS vocab_size, (SELECT max(event_id) FROM events) - m.ts <= 3 AS active
 FROM (SELECT * FROM m ORDER BY ts DESC LIMIT 1) m, (SELECT * FROM t ORDER BY step DESC LIMIT 1) t, (SELECT * FROM e ORDER BY step DESC LIMIT 1) e"""


@register("telemetry", TEL)
def telemetry(s: SparkSession, d: str) -> DataFrame:
    ev = B.table(s, d, "events")
    met = ev.where("event_type = 'click'").selectExpr("event_id AS ts", "event_id % 7 AS steps", "value AS training_loss", "value / 2 AS validation_loss", "user_id AS dataset_size", "event_id % 50 AS raw_queue", "event_id % 3 AS token_queue",
                                                      "event_id + 1 AS levels_scraped", "value / 3 AS token_entropy")
    train = ev.where("event_type = 'view'").selectExpr("event_id AS step", "CASE WHEN event_id % 2 = 0 THEN 0D ELSE value END AS train_loss", "value AS eval_loss")
    now = ev.agg(F.max("event_id").alias("_now"))
    out = M.telemetry(met, train, ev.where("event_type <> 'view'").selectExpr("event_id AS step", "value AS diversity"), ev.selectExpr("event_id AS ts", "event_type AS event"), vocab_size=67)
    return out.crossJoin(now).withColumn("active", M.is_recent(F.col("heartbeat"), F.col("_now"), 3)).drop("_now").withColumn("token_entropy", F.round("token_entropy", 6))


register("telemetry_idle", """SELECT CAST(NULL AS BIGINT) AS heartbeat, (SELECT max(event_id) FROM events) AS step, CAST(floor((SELECT max(event_id) FROM events) / 10000) + 1 AS BIGINT) AS epoch, (SELECT CASE WHEN count(*) > 0 THEN 1e2 ELSE 0e0 END FROM events) AS progress_pct,
 0e0 AS loss, 0e0 AS val_loss, 0e0 AS generation_diversity, (SELECT count(*) FROM events) AS dataset_size, 'orchestrator_idle' AS event, false AS active""")(
    lambda s, d: (lambda ev: M.telemetry(ev.where("event_id < 0").selectExpr("event_id AS ts"), ev.selectExpr("event_id AS step"), ev.where("event_id < 0").selectExpr("event_id AS step"), dataset_rows=ev.count()))(B.table(s, d, "events"))
    .select("heartbeat", "step", "epoch", "progress_pct", "loss", "val_loss", "generation_diversity", "dataset_size", "event", "active"))
register("tokens_to_gameplay", sql("SELECT s.level_id, r.token, r.x_step, r.y_lane, r.level_id IS NULL AS missing FROM seqs s LEFT JOIN (SELECT * FROM runs WHERE level_id % 11 <> 10) r USING (level_id)", "emit"))(
    lambda s, d: O.tokens_to_gameplay(B.levels(s, d).select("level_id"), O.gameplay_objects(B.objects(s, d)).where("level_id % 11 <> 10").select("level_id", "token", "x_step", "y_lane")))
register("decoded_extent", more("ol") + """ t AS (SELECT l_orderkey * 8 + l_linenumber AS level_id, l_partkey % 100 AS a, l_suppkey AS b, l_quantity AS q, l_discount AS dd, l_linenumber AS n, l_tax AS tax FROM ol),
 o AS (SELECT level_id, q AS x, CAST(n AS DOUBLE) AS y FROM t WHERE a > 0 UNION ALL SELECT level_id, 0, tax FROM t WHERE b > 0 UNION ALL SELECT level_id, dd, 0 FROM t)
 SELECT level_id, 'kS1,0' AS header, count(*) AS object_count_raw, round(min(x), 6) AS x_min, round(max(x), 6) AS x_max, round(min(y), 6) AS y_min, round(max(y), 6) AS y_max FROM o GROUP BY 1""")(
    lambda s, d: (lambda t: O.level_extent(R.explode_objects(t), t).drop("decoded_length"))(B.level_texts(s, d)))
