"""Raw response text to records: pure column expressions over a table of strings.

Input rows are ``(request_id, source, page, raw)``.  Pair text is split once
into an array of (k, v); fields are picked from it.
"""
from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType

from lanestride.functions.columns import finite, pairs, pairs_map, pairs_sql, pick, pick_sql, to_float, to_int, unnest

# Field codes of the response format and their labels.
DIFFICULTY_LABELS = {0: "NA", 10: "EASY", 20: "NORMAL", 30: "HARD", 40: "HARDER", 50: "INSANE"}
DEMON_LABELS = {3: "EASY_DEMON", 4: "MEDIUM_DEMON", 5: "INSANE_DEMON", 6: "EXTREME_DEMON"}
LENGTH_LABELS = {0: "TINY", 1: "SHORT", 2: "MEDIUM", 3: "LONG", 4: "XL", 5: "PLATFORMER"}


def _label(code: Column, labels: dict[int, str], default: str) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for key, text in labels.items():
        out = out.when(code == key, text)
    return out.otherwise(default)


def num(p: str, key: str) -> Column:
    return to_int(pick(p, key))


def difficulty_label(p: str = "p") -> Column:
    return (F.when(num(p, "25") > 0, "AUTO")
             .when(num(p, "17") > 0, _label(num(p, "43"), DEMON_LABELS, "HARD_DEMON"))
             .when(num(p, "8") == 0, "NA").otherwise(_label(num(p, "9"), DIFFICULTY_LABELS, "NA")))


def length_label(p: str = "p") -> Column:
    return _label(num(p, "15"), LENGTH_LABELS, "UNKNOWN")


def song_id(p: str = "p") -> Column:
    return F.when(num(p, "35") > 0, num(p, "35")).otherwise(num(p, "12") + 1)


def song_type(p: str = "p") -> Column:
    return F.when(num(p, "35") > 0, "custom").otherwise("official")


def is_auto(p: str = "p") -> Column:
    return num(p, "25") > 0


def name_contains_all(name: Column, terms: list[str]) -> Column:
    """Every term occurs in the name, ignoring case; an empty list passes."""
    out = F.lit(True)
    for term in terms:
        out = out & F.contains(F.lower(name), F.lit(term.lower()))
    return out


def is_empty(raw: str = "raw") -> Column:
    return F.coalesce(F.col(raw), F.lit("")).isin("") | (F.trim(raw) == "-1")


def section(raw: str, index: int) -> Column:
    return F.coalesce(F.get(F.split(raw, "#"), F.lit(index)), F.lit(""))


INT = "coalesce(try_cast(trim({}) AS bigint), 0L)"


def creator_list(raw: str = "raw", index: int = 1) -> Column:
    """The creators of a response in order: array of (player_id, username, account_id); bad entries are left out."""
    entries = f"transform(split(coalesce(get(split({raw}, '#'), {index}), ''), '[|]'), c -> split(c, ':'))"
    whole = f"filter({entries}, f -> size(f) >= 3 AND NOT startswith(f[0], '~') AND {INT.format('f[0]')} > 0)"
    return F.expr(f"transform({whole}, f -> named_struct('player_id', {INT.format('f[0]')}, 'username', f[1], 'account_id', {INT.format('f[2]')}))")


def song_list(raw: str = "raw", index: int = 2) -> Column:
    """The songs of a response in order: array of (song_id, name, artist, size, download_url, raw_song, p), ``p`` all pairs.

    ``pos`` is the place among the non-empty entries; entries without a positive id are left out.
    """
    text = f"trim(coalesce(get(split({raw}, '#'), {index}), ''))"
    listed = f"filter(split({text}, ':(?=~?1~[|]~)'), x -> x <> '')"
    clean = "regexp_replace(regexp_replace(trim(x), '^~', ''), '~$', '')"
    tagged = f"transform({listed}, (x, n) -> named_struct('pos', n, 'raw_song', x, 'p', {pairs_sql(clean, '~|~')}))"
    field = lambda k: f"coalesce({pick_sql('s.p', k)}, '')"
    made = (f"transform({tagged}, s -> named_struct('pos', s.pos, 'song_id', {INT.format(pick_sql('s.p', '1'))}, 'name', {field('2')}, 'artist', {field('4')}, "
            f"'size', {field('5')}, 'download_url', {field('10')}, 'raw_song', s.raw_song, 'p', s.p))")
    return F.expr(f"CASE WHEN {text} IN ('', '~') THEN filter({made}, s -> false) ELSE filter({made}, s -> s.song_id > 0) END")


#: Levels are parsed inside the array, so that filters on their fields, which the engine moves down, do not parse them again.
LEVEL_LIST = f"transform(filter(split(_s, '[|]'), x -> x <> ''), x -> named_struct('raw_level', x, 'p', {pairs_sql('x', ':')}))"


# -- search responses ---------------------------------------------------------
def explode_search(responses: DataFrame) -> DataFrame:
    """One row per level of a search response: input columns, ``pos``, ``raw_level``, the page's ``creators``, pairs ``p``."""
    rest = [c for c in responses.columns if c != "raw"]
    rows = (responses.where(~is_empty()).withColumn("_s", section("raw", 0)).withColumn("creators", creator_list())
            .transform(lambda r: unnest(r, *rest, "creators", _level=F.expr(LEVEL_LIST))))
    return rows.select(*rest, "creators", "pos", "_level.raw_level", "_level.p")


def creators(responses: DataFrame, index: int = 1) -> DataFrame:
    """``(request_id, player_id, username, account_id)``; the last entry per id wins."""
    rows = unnest(responses.where(~is_empty()).select("request_id", creator_list("raw", index).alias("_l")), "request_id", c=F.col("_l"))
    last = lambda c: F.max_by(F.col(f"c.{c}"), "pos").alias(c)
    return rows.groupBy("request_id", F.col("c.player_id").alias("player_id")).agg(last("username"), last("account_id"))


def songs(responses: DataFrame, index: int = 2) -> DataFrame:
    """Song rows of a response: ``(request_id, pos, song_id, name, artist, size, download_url, raw_song, parsed)``."""
    rows = responses.where(~is_empty()).select("request_id", song_list("raw", index).alias("_l"))
    return (unnest(rows, "request_id", s=F.col("_l")).drop("pos").select("request_id", "s.*").withColumn("parsed", pairs_map("p")).drop("p"))


def page_info(text: Column) -> Column:
    """``total:offset:amount`` as a struct, NULL with fewer than three parts."""
    f = F.split(text, ":")
    return F.when(F.size(f) >= 3, F.struct(to_int(F.get(f, F.lit(0))).alias("total"), to_int(F.get(f, F.lit(1))).alias("offset"),
                                           to_int(F.get(f, F.lit(2))).alias("amount")))


SEARCH_FIELDS = ["difficulty", "downloads", "likes", "stars", "length", "version", "game_version", "object_count_hint", "song_id", "song_type",
                 "featured_score", "epic_score"]


def candidates(levels: DataFrame) -> DataFrame:
    """Typed candidate rows from exploded search levels.

    A level's creator stands in the same response, so it is looked up inside
    the row (the last entry of an id wins) and nothing is exchanged.
    """
    found = F.expr("element_at(transform(array(filter(creators, c -> c.player_id = player_id)), f -> get(f, size(f) - 1)), 1)")
    typed = levels.withColumn("player_id", num("p", "6")).select(
        "request_id", "source", "page", "pos", "raw_level", num("p", "1").alias("level_id"), "player_id",
        F.coalesce(pick("p", "2"), F.lit("")).alias("name"), is_auto().alias("is_auto"),
        difficulty_label().alias("difficulty"), num("p", "10").alias("downloads"), num("p", "14").alias("likes"),
        num("p", "18").alias("stars"), length_label().alias("length"), num("p", "5").alias("version"),
        num("p", "13").alias("game_version"), num("p", "45").alias("object_count_hint"), song_id().alias("song_id"),
        song_type().alias("song_type"), num("p", "19").alias("featured_score"), num("p", "42").alias("epic_score"),
        found.alias("_who"))
    return (typed.where("level_id > 0").withColumn("author", F.coalesce("_who.username", F.lit("-")))
            .withColumn("account_id", F.coalesce("_who.account_id", F.lit(0))).drop("_who"))


# -- download responses -------------------------------------------------------
def download_fields(responses: DataFrame) -> DataFrame:
    """Split downloads into pairs ``p``, hashes, user and ``reason`` (NULL when usable)."""
    raw = F.coalesce("raw", F.lit(""))
    rows = responses.withColumn("_s", section("raw", 0))
    # parsed once, as a generated column: a filter on the reason does not parse again
    rows = rows.withColumn("p", F.explode(F.array(pairs("_s", ":"))))
    reason = (F.when(raw == "", "empty_response").when(F.trim(raw) == "-1", "not_found_response")
               .when(F.col("_s") == "", "missing_level_object")
               .when(F.coalesce(pick("p", "1"), F.lit("")) == "", "missing_level_id"))
    return (rows.withColumn("hash1", section("raw", 1)).withColumn("hash2", section("raw", 2))
                .withColumn("user", section("raw", 3)).withColumn("reason", reason).drop("_s"))


def comments(responses: DataFrame) -> DataFrame:
    """The record of each comment page: all input columns (level_id, source, mode, page, count, ... and ``raw``), the comments,
    their number and the page info."""
    body = F.substring_index("raw", "#", 1)
    tail = F.when(F.contains("raw", F.lit("#")), F.expr("substring(raw, instr(raw, '#') + 1)")).otherwise(F.lit(""))
    listed = F.filter(F.split(body, r"\|"), lambda x: x != "")
    none = F.expr("CAST(array() AS array<string>)")
    rows = responses.withColumn("comments", F.when(is_empty(), none).otherwise(listed))
    return rows.withColumn("comment_count", F.size("comments").cast("bigint")).withColumn(
        "page_info", F.when(~is_empty(), page_info(tail)))


def audio_metadata(downloads: DataFrame, index: int = 4) -> DataFrame:
    """Add the referenced song, looked up inside the same response by song id (the last entry of an id wins)."""
    fields = "named_struct(" + ", ".join(f"'{f}', s.{f}" for f in ("name", "artist", "size", "download_url", "raw_song")) + ", 'p', s.p)"
    rows = downloads.withColumn("song_id", song_id()).withColumn("song_type", song_type()).withColumn("_l", song_list("raw", index))
    rows = rows.withColumn("_m", F.expr("filter(_l, s -> s.song_id = song_id)"))
    rows = rows.withColumn("_one", F.expr(f"CASE WHEN size(_m) > 0 THEN element_at(transform(_m, s -> {fields}), -1) END"))
    song = F.when(F.col("_one").isNotNull(), F.struct("_one.name", "_one.artist", "_one.size", "_one.download_url", "_one.raw_song", pairs_map("_one.p").alias("parsed")))
    has = F.col("_one").isNotNull()
    ready = (F.col("song_type") == "custom") & has & (F.coalesce("_one.download_url", F.lit("")) != "")
    return (rows.withColumn("song", song).withColumn("has_custom_song_metadata", has).withColumn("conditioning_ready", ready)
            .drop("_l", "_m", "_one"))


AUDIO = ["song_id", "song_type", "has_custom_song_metadata", "conditioning_ready", "song"]


def audio_records(downloads: DataFrame, candidate_rows: DataFrame) -> DataFrame:
    """Audio rows of usable downloads (with audio) and their candidates: ids, source, page and the audio fields."""
    side = candidate_rows.select("level_id", F.col("source").alias("_source"), F.col("page").alias("_page"))
    good = downloads.where("reason IS NULL").withColumn("level_id", num("p", "1"))
    return good.join(side, "level_id").select("level_id", "song_id", "song_type", F.col("_source").alias("source"), F.col("_page").alias("source_page"),
                                              F.struct(*AUDIO).alias("audio"))


def payload_counts(downloads: DataFrame) -> DataFrame:
    """Add ``object_count`` and ``decoded_length`` of each download's payload, in its own row."""
    rows = downloads.withColumn("_reason", F.col("reason")).withColumn("_data", F.coalesce(pick("p", "4"), F.lit("")))
    checked = validate_payload(decode_payload(rows, "_data"), "_data")
    return checked.withColumn("reason", F.col("_reason")).drop("_reason", "_data", "decoded", "decode_reason")


def level_records(downloads: DataFrame, candidate_rows: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Final level rows from usable downloads (with audio) and their candidates.

    Missing names and authors fall back to the candidate, then to ``-``.  A
    download's fields are taken from its pairs before the join, so only what the record
    keeps is exchanged.  Payload counts come from ``validation`` or, without it, from the
    downloads' own columns (:func:`payload_counts`), if they have them.
    """
    c = F.col
    blank = lambda x: F.nullif(x, F.lit(""))
    side = candidate_rows.select(
        F.col("level_id"), F.col("name").alias("_name"), F.col("author").alias("_author"), F.col("player_id").alias("_player"),
        F.col("account_id").alias("_account"), F.col("sequence").alias("candidate_sequence"), F.col("source").alias("source"),
        F.col("page").alias("source_page"), *[F.col(f).alias(f"_search_{f}") for f in SEARCH_FIELDS])
    user = F.when(F.size(F.split("user", ":")) >= 2, F.get(F.split("user", ":"), F.lit(1)))
    counted = validation is None and "object_count" in downloads.columns
    good = downloads.where("reason IS NULL").select(
        "request_id", num("p", "1").alias("level_id"), blank(pick("p", "2")).alias("_given"), blank(user).alias("_user"), difficulty_label().alias("difficulty"),
        num("p", "10").alias("downloads"), num("p", "14").alias("likes"), *AUDIO, "hash1", F.coalesce(pick("p", "4"), F.lit("")).alias("level_data"), "raw", "hash2",
        F.nullif(num("p", "6"), F.lit(0)).alias("_own_player"), F.coalesce(pick("p", "3"), F.lit("")).alias("description_b64"), num("p", "5").alias("version"),
        num("p", "13").alias("game_version"), num("p", "18").alias("stars"), length_label().alias("length"),
        num("p", "37").alias("coins"), (num("p", "38") > 0).alias("verified_coins"), num("p", "19").alias("featured_score"),
        num("p", "42").alias("epic_score"), num("p", "45").alias("object_count_hint"),
        *(["object_count", "decoded_length"] if counted else []))
    joined = good.join(side, "level_id")
    if validation is not None:
        joined = joined.join(validation.select("request_id", "object_count", "decoded_length"), "request_id")
    elif not counted:
        joined = joined.withColumn("object_count", F.lit(None).cast("bigint")).withColumn("decoded_length", F.lit(None).cast("bigint"))
    return joined.select(
        "level_id", F.coalesce("_given", "_name").alias("name"),
        F.coalesce(c("_user"), blank(c("_author")), F.lit("-")).alias("author"), "difficulty",
        "downloads", "likes", "song_id", "song_type",
        F.struct(*AUDIO).alias("audio"),
        "source", "source_page", "object_count", c("hash1").alias("level_hash"), "level_data", "raw",
        F.struct(c("hash2").alias("download_hash2"), "candidate_sequence",
                 F.coalesce(c("_own_player"), c("_player")).alias("player_id"), c("_account").alias("account_id"),
                 "description_b64", "version", "game_version", "stars", "length", "coins", "verified_coins", "featured_score",
                 "epic_score", "object_count_hint", "decoded_length",
                 F.struct(*[c(f"_search_{f}").alias(f) for f in SEARCH_FIELDS]).alias("search")).alias("metadata"))


# -- payload decode -----------------------------------------------------------
def _inflate(data: bytes | None) -> bytes | None:
    try:
        return None if data is None else zlib.decompress(data, 15 | 32)
    except zlib.error:
        return None


@F.pandas_udf(BinaryType())
def inflate(column: pd.Series) -> pd.Series:
    """zlib or gzip bytes, NULL when damaged.  Spark has no inflate function."""
    return column.map(_inflate)


def decode_payload(rows: DataFrame, column: str) -> DataFrame:
    """Add ``decoded`` text and ``decode_reason``.  Only the payload crosses into Python."""
    clean = F.translate(column, "-_", "+/")
    padded = F.rpad(clean, (F.ceil(F.length(clean) / 4) * 4).cast("int"), "=")
    strict = F.when(F.regexp_like(padded, F.lit("^[A-Za-z0-9+/]*={0,2}$")), F.try_to_binary(padded, F.lit("base64")))
    out = rows.withColumn("_b", strict).withColumn("_z", inflate("_b")).withColumn("_t", F.try_validate_utf8("_z"))
    reason = (F.when(F.col("_b").isNull(), "base64_decode_failed").when(F.col("_z").isNull(), "zlib_decode_failed")
               .when(F.col("_t").isNull(), "unicode_decode_failed"))
    return out.withColumn("decode_reason", reason).withColumn("decoded", F.col("_t").cast("string")).drop("_b", "_z", "_t")


def validate_payload(decoded: DataFrame, column: str) -> DataFrame:
    """Add ``object_count``, ``decoded_length`` and ``reason`` (missing, decode failure, zero objects)."""
    n = F.expr("size(filter(slice(split(decoded, ';'), 2, greatest(0, size(split(decoded, ';')) - 1)), x -> trim(x) <> ''))")
    out = decoded.withColumn("object_count", F.coalesce(n, F.lit(0)).cast("bigint")).withColumn(
        "decoded_length", F.coalesce(F.length("decoded"), F.lit(0)).cast("bigint"))
    return out.withColumn("reason", F.when(F.coalesce(F.col(column), F.lit("")) == "", "level_data_missing")
                          .when(F.col("decode_reason").isNotNull(), F.col("decode_reason"))
                          .when(F.col("object_count") == 0, "zero_objects"))


def explode_objects(decoded: DataFrame, text: str = "decoded", key: str = "level_id") -> DataFrame:
    """Object rows of decoded level text: ``(key, seq, object_id, x, y, rotation, scale)``.

    ``seq`` is the section index; objects without a positive id or with a coordinate that is not finite are dropped.
    """
    parts = unnest(decoded, key, raw=F.split(text, ";")).withColumnRenamed("pos", "seq").where("seq > 0 AND trim(raw) <> ''")
    rows = parts.withColumn("_raw", F.trim("raw")).withColumn("p", pairs("_raw", ","))
    f = lambda k, d=0.0: F.coalesce(to_float(F.nullif(pick("p", k), F.lit("")), None), F.lit(d))
    return rows.select(key, F.col("seq").cast("bigint").alias("seq"), num("p", "1").alias("object_id"), f("2").alias("x"), f("3").alias("y"),
                       f("6").alias("rotation"), f("32", 1.0).alias("scale")).where((F.col("object_id") > 0) & finite("x") & finite("y"))
