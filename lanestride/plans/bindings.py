"""Bind the operators' inputs to the given tables.

Every binding is row-local (no grouping), so a registered query's plan shows
only what its operator needs.
"""
from __future__ import annotations

import base64
import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from lanestride.dims import DEFAULT
from lanestride.functions.columns import sql_text

LABELS = ["easy", "Normal", " HARD ", "Insane Demon", "EXTREME_DEMON", "auto", "harder", "easy demon", "???"]
SOURCES = ["", "recent", "featured", "awarded", "trending"]
HOUR_US = 3_600_000_000
EPOCH_US = 1_704_067_200_000_000


#: Session setting: deal every table that is read to so many partitions.  For tables of fewer row groups than cores; unset, a table is read as it lies.
INPUT_PARTITIONS = "lanestride.input.partitions"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
    dealt = spark.conf.get(INPUT_PARTITIONS, None)
    return rows.repartition(int(dealt)) if dealt else rows


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _micros() -> str:
    return "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"


def objects(spark: SparkSession, sf: str) -> DataFrame:
    """Events as placed objects: one level per user."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("level_id"), F.col("event_id").alias("seq"),
        F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)").alias("object_id"),
        F.expr(f"({_micros()} - {EPOCH_US}) / {float(HOUR_US)}D").alias("x"), F.col("value").alias("y"))


def levels(spark: SparkSession, sf: str) -> DataFrame:
    pick = lambda values, n: F.expr(f"element_at(array({', '.join(sql_text(v) for v in values)}), int(user_id % {n}) + 1)")
    return (table(spark, sf, "events").select("user_id").distinct()
            .select(F.col("user_id").alias("level_id"), pick(LABELS, 9).alias("difficulty"), pick(SOURCES, 5).alias("source")))


def words(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as plain word sequences."""
    return documents(spark, sf).select(
        F.col("doc_id").alias("level_id"), "source", F.expr("filter(split(text, ' '), w -> w <> '')").alias("tokens"))


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as dirty token sequences: each word is mapped to a vocabulary token.

    A third of them is framed by start and end marks, a third by a start only.
    """
    mapped = (f"transform(filter(split(text, ' '), w -> w <> ''), "
              f"w -> element_at({DEFAULT.vocabulary_array_sql()}, int((ascii(w) * 7 + length(w)) % {len(DEFAULT.base_vocabulary)}) + 1))")
    head = "CASE WHEN doc_id % 3 < 2 THEN array('START', 'DIFF_HARD', 'ALIGN_UNKNOWN') ELSE array() END"
    tail = "CASE WHEN doc_id % 3 = 0 THEN array('END') ELSE array() END"
    return documents(spark, sf).select(
        F.col("doc_id").alias("level_id"), "source", F.expr(f"concat({head}, {mapped}, {tail})").alias("tokens"))


def speech(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as long token rows."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("level_id"), F.col("turn").alias("pos"), F.col("role").alias("token"))


def series_points(spark: SparkSession, sf: str) -> DataFrame:
    """Events as five series of (t in hours, value)."""
    return table(spark, sf, "events").select(
        F.expr("user_id % 5").alias("series"), F.expr(f"({_micros()} - {EPOCH_US}) / {float(HOUR_US)}D").alias("t"), "value")


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("code"), F.expr(f"{_micros()} div 1000000").alias("ts"))


ORDER_LINES = """o_orderkey AS l_orderkey, CAST(o_orderkey % 7 + 1 AS INT) AS l_linenumber, o_custkey AS l_partkey, o_orderkey % 100 + 1 AS l_suppkey,
 CAST(CAST(floor(o_totalprice) AS BIGINT) % 50 + 1 AS INT) AS l_quantity, CAST(o_orderkey % 11 AS DOUBLE) AS l_discount, CAST(o_custkey % 9 AS DOUBLE) AS l_tax,
 o_orderstatus AS l_returnflag, o_orderstatus AS l_linestatus"""


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under short names: the unique key and a few small numbers to build raw text from."""
    return table(spark, sf, "orders").selectExpr(*[e.strip() for e in _split_top(ORDER_LINES)])


def _split_top(text: str) -> list[str]:
    """Split a select list at commas outside parentheses."""
    out, depth = [""], 0
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append("")
        else:
            out[-1] += ch
    return out


SEARCH_SQL = """
concat(
 '1:', l_orderkey * 8 + l_linenumber, ':2:Part ', l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN ' Layout' ELSE ' remake' END,
 ':5:', l_linenumber, ':6:', l_suppkey, ':8:', CASE WHEN l_linenumber = 3 THEN '0' ELSE '10' END, ':9:', 10 * (l_suppkey % 7),
 ':10:5:10:', int(l_quantity), ':12:', l_suppkey % 20, ':14:x', ':15:', l_linenumber, ':17:', CASE WHEN l_returnflag = 'R' THEN '1' ELSE '' END,
 ':43:', l_partkey % 8, ':25:', CASE WHEN l_partkey % 11 = 0 THEN '1' ELSE '' END, ':35:', CASE WHEN l_partkey % 3 = 0 THEN l_partkey ELSE 0 END, ':odd',
 '||1:0:2:none',
 '#', l_suppkey, ':Old:1|', l_suppkey, ':Supplier', l_suppkey, ':', l_suppkey * 3, '|~skip:a:1|0:zero:5|bad',
 '#~1~|~', l_partkey, '~|~2~|~Song ', l_partkey, '~|~4~|~Artist~|~5~|~1.5~|~10~|~', CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE 'http://x/y' END,
 '~:~1~|~7~|~2~|~Extra~', '#', int(l_quantity), ':', l_linenumber, ':10#hash')
"""


def search_responses(spark: SparkSession, sf: str) -> DataFrame:
    """One raw search response per order line."""
    return order_lines(spark, sf).select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("request_id"), F.col("l_linestatus").alias("source"),
        F.col("l_linenumber").alias("page"), F.expr(SEARCH_SQL).alias("raw"))


DOWNLOAD_SQL = """
CASE WHEN l_linenumber = 6 THEN '' WHEN l_linenumber = 7 THEN ' -1 ' WHEN l_linenumber = 5 THEN '#h#h' WHEN l_partkey % 13 = 0 THEN '2:nameless#h#h'
ELSE concat('1:', l_orderkey * 8 + l_linenumber, ':2:', CASE WHEN l_partkey % 2 = 0 THEN concat('Name ', l_partkey) ELSE '' END,
 ':3:ZGVzYw', ':5:', l_linenumber, ':6:', l_suppkey, ':8:10:9:', 10 * (l_suppkey % 7), ':10:', int(l_quantity), ':12:', l_suppkey % 20,
 ':15:', l_linenumber, ':35:', CASE WHEN l_partkey % 3 = 0 THEN l_partkey ELSE 0 END,
 '#h', l_orderkey, '#g', l_partkey, '#', CASE WHEN l_suppkey % 2 = 0 THEN concat(l_suppkey, ':User', l_suppkey) ELSE '' END,
 '#1~|~', l_partkey, '~|~2~|~Song~|~10~|~', CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE 'http://x/y' END) END
"""


def download_responses(spark: SparkSession, sf: str) -> DataFrame:
    return order_lines(spark, sf).select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("request_id"), F.col("l_linestatus").alias("source"),
        F.col("l_linenumber").alias("page"), F.expr(DOWNLOAD_SQL).alias("raw"))


def level_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded level text per order line: three objects, one without an id, one blank section."""
    text = ("concat('kS1,0;1,', l_partkey % 100, ',2,', l_quantity, ',3,', l_linenumber, ',6,90; ;1,0,2,5,3,5;"
            "1,', l_suppkey, ',2,x,3,', l_tax, ',32,2.5;1,8,1,', l_linenumber, ',2,', l_discount, ';odd')")
    return order_lines(spark, sf).select(F.expr("l_orderkey * 8 + l_linenumber").alias("level_id"), F.expr(text).alias("decoded"))


def chunk_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Reference objects: five levels, x in units, the raw string kept for rewriting."""
    raw = "concat('1,', object_id, ',2,', x, ',3,', y, ',21,1004')"
    return (objects(spark, sf).selectExpr("level_id % 5 AS level_id", "object_id", "x * 30 AS x", "y", "seq").withColumn("raw", F.expr(raw)))


@F.pandas_udf(StringType())
def deflate_urlsafe(column: pd.Series) -> pd.Series:
    """Text to gzip and URL-safe base64 without padding: level payloads for the queries."""
    pack = lambda s: None if s is None else base64.urlsafe_b64encode(gzip.compress(s.encode(), mtime=0)).decode().rstrip("=")
    return column.map(pack)


def level_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Levels as raw records: the objects of ``objects`` that have an id, encoded; one record a level."""
    text = F.concat_ws(",", F.lit("1"), "object_id", F.lit("2"), "x", F.lit("3"), "y")
    lines = objects(spark, sf).where("object_id > 0").withColumn("text", text).groupBy("level_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda o: o.text), ";").alias("body"))
    return levels(spark, sf).join(lines, "level_id").select(
        "level_id", "difficulty", F.lit(0).cast("bigint").alias("song_id"), F.lit("").alias("song_type"), "source",
        deflate_urlsafe(F.concat(F.lit("kS1,0;"), "body")).alias("level_data"), F.col("level_id").alias("ingest_order"))
